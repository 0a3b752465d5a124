"""The sender allowlist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON array of strings, one row each, in column ``sender``.

    A missing file, text that is not JSON and JSON that is not an array of
    strings are
    errors when the rows are read: taking them for an empty list would drop all
    mail. An empty array is a valid list.
    """
    refuse = F.raise_error(F.lit("the sender allowlist must be a JSON array of strings"))
    # An empty file has no row: gathering the file's text into one row notices that.
    files = spark.read.text(path, wholetext=True).agg(F.collect_list("value").alias("files"))
    whole = files.select(
        F.explode(F.when(F.size("files") > 0, F.col("files")).otherwise(refuse)).alias("value")
    )
    entries = F.from_json("value", "array<string>", {"mode": "FAILFAST"})
    whole_list = F.col("value").rlike(r"\A\s*\[") & ~F.exists(entries, lambda e: e.isNull())
    checked = F.when(whole_list, entries).otherwise(refuse)
    return whole.select(F.explode(checked).alias("sender")).distinct()


def write_allowlist(entries: DataFrame, path: str) -> None:
    """Write entries (column ``sender``) as one JSON array; a hand-sized list, so one file."""
    sorted_list = F.sort_array(F.collect_set("sender"))
    entries.agg(F.to_json(sorted_list).alias("value")).coalesce(1).write.mode("overwrite").text(path)
