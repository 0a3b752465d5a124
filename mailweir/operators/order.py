"""Sorting, top-k and first/last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailweir.session import ensure_checkpoint_dir


def recent_order() -> list[Column]:
    """Latest first, messages without a date last, ties by id."""
    return [F.col("parsed_ts").desc_nulls_last(), F.col("id").asc()]


def sort_recent(mail: DataFrame) -> DataFrame:
    return mail.orderBy(*recent_order())


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Sort and number all rows from 1 without gathering them in one task.

    The sorted rows are written once to the checkpoint folder, which fixes what
    lies in which partition, also if executors are lost. One count per partition
    then gives each partition its offset.
    """
    ensure_checkpoint_dir(df.sparkSession)
    row_bits = F.lit((1 << 33) - 1)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftrightunsigned("_mark", 33))
    )
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort, whatever the size of the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    numbered = fixed.join(F.broadcast(offsets), "_part")
    position = F.col("_offset") + F.col("_mark").bitwiseAND(row_bits) + 1
    return numbered.withColumn(name, position).drop("_part", "_mark", "_offset")


def top_k(counts: DataFrame, k: int, by: str, *ties: Column) -> DataFrame:
    """The ``k`` rows with the highest count, equal counts in the order of ``ties``."""
    return counts.orderBy(F.col(by).desc(), *ties).limit(k)


def first_last(mail: DataFrame, *columns: str) -> DataFrame:
    """The first and the last dated message as whole rows, found without sorting."""
    row = F.struct("parsed_ts", "id", *columns)
    dated = mail.filter(F.col("parsed_ts").isNotNull())
    return dated.agg(F.min(row).alias("first"), F.max(row).alias("last"))


def sample_subjects(mail: DataFrame, k: int = 5) -> DataFrame:
    """``k`` subjects, by id so that the choice is repeatable."""
    shown = F.coalesce(F.col("subject"), F.lit("No subject"))
    return mail.select("id", shown.alias("subject")).orderBy("id", "subject").limit(k)
