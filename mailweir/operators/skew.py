"""Joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweir.session import stage

#: At most this many keys are salted; a key outside the list is a small share of the rows.
HOT_KEYS = 256
#: Counters kept by each frequent-items sketch. Any key above 1/3000 of the rows is found.
HOT_COUNTERS = 4096
#: Sketches are merged in this many tasks before the last merge, which then sees only these.
SKETCH_GROUPS = 256
#: A key below this many rows fits a task and needs no salt.
HOT_ROWS = 100_000
#: Tasks a hot key is spread over.
SALTS = 64


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with most rows, at most ``HOT_KEYS`` of them.

    One sketch per input partition, merged in two steps: neither the keys nor all
    sketches pass through one task. It decides only how rows travel, never which
    rows are in a result.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    call, counters = F.call_function, F.lit(HOT_COUNTERS)
    sketches = (
        df.select(group, F.col(key).alias("_key"))
        .groupBy("_group")
        .agg(call("approx_top_k_accumulate", F.col("_key"), counters).alias("_sketch"))
    )
    # Grouped, if only by a constant: a table without rows has no sketch to merge.
    merged = sketches.groupBy(F.lit(0).alias("_one")).agg(
        call("approx_top_k_combine", F.col("_sketch"), counters).alias("_sketch")
    )
    top = call("approx_top_k_estimate", F.col("_sketch"), F.lit(HOT_KEYS))
    return (
        merged.select(F.explode(top).alias("_t"))
        .filter((F.col("_t.count") >= min_rows) & F.col("_t.item").isNotNull())
        .select(F.col("_t.item").alias(key))
    )


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join a table with repeated keys to one whose keys are unique: left, semi or anti.

    In such joins adaptive execution splits a hot key's left rows at run time, from sizes it
    has measured, so the left side is not read beforehand to find them. It can where both
    sides are shuffled for the join itself; the right side, which mostly comes out of an
    aggregation by the same key, is therefore written first. With adaptive execution
    switched off the salt does it. The rows are the same.
    """
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if all(left.sparkSession.conf.get(s) == "true" for s in settings):
        return left.join(stage(right, "keys"), key, how)
    return salted_join(left, right, key, how)


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str,
    min_rows: int = HOT_ROWS, salts: int = SALTS,
) -> DataFrame:
    """Join a table with repeated keys to one whose keys are unique.

    Left rows of a hot key are numbered by the partition they come from and the
    matching right row is copied once per number, so that every left row still
    meets exactly its own match. Rows with a NULL key match nothing and are
    spread as well. The broadcast side has at most ``HOT_KEYS`` rows.
    """
    # Written once: both sides have to be spread by the same list.
    listed = stage(hot_keys(left, key, min_rows).withColumn("_hot", F.lit(True)), "hot-keys")
    hot = F.broadcast(listed)
    spread = F.pmod(F.spark_partition_id(), F.lit(salts))
    numbered = left.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    copies: Column = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    copied = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return numbered.drop("_hot").join(copied, [key, "_salt"], how).drop("_salt")
