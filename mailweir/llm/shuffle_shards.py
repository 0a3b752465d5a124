"""Sharding by a two-pass external shuffle.

Pass one scatters the records into buckets by a seeded hash; there are enough buckets
that one fits a task's memory. Pass two Fisher-Yates shuffles each bucket and writes it:
Spark's ``shuffle`` of the bucket's places is that algorithm, so only a list of numbers is
held in memory, and the records are sorted into their new places with spilling.

Buckets follow each other, so that every record has one place among all, and the places
are cut into shards of equal length: the law ``rows``, counts at most one apart. A bucket is
written to one shard or two.

The permutation depends on the seed, the bucket and the number of buckets, not on task
order, so a lost executor's work is redone alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import table
from mailweir.session import run_dir, stage

#: Bytes of records in a bucket, on which alone the number of buckets depends.
BUCKET_BYTES = 16 << 20
#: Repeated rows, as hashes of 8 bytes, up to which they are sent to every task.
BROADCAST_ROWS = 1 << 18
#: What a record weighs besides its text.
OVERHEAD = 16


def text_bytes(text: str | Column = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def _chances(docs: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """The records with the number that decides on their bucket and their turn in it.

    It is a hash of the whole record. Records equal in all columns would all fall together, so
    those are told apart by where they stand in the input.
    """
    chance = F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(seed))
    keyed = docs.select(chance.alias("_chance"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_record"))
    repeats = docs.select(chance.alias("_chance")).groupBy("_chance").count().filter("count > 1")
    repeats = stage(repeats.select("_chance", F.lit(True).alias("_again")), "shard-repeats")
    n = repeats.count()
    if not n:
        return keyed
    # Numbers are given before anything is moved, so a task that is done again gives the same ones.
    numbered = keyed.withColumn("_number", F.monotonically_increasing_id())
    small = F.broadcast(repeats) if n <= BROADCAST_ROWS else repeats
    told = F.when(F.col("_again"), F.xxhash64("_chance", "_number")).otherwise(F.col("_chance"))
    return numbered.join(small, "_chance", "left").select(told.alias("_chance"), "_record")


def shuffled(
    docs: DataFrame, n_shards: int = 40, text: str = "text", seed: int = 5,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All records with the ``shard`` and ``slot`` they fall to, in order within each task.

    Input columns named ``shard`` or ``slot`` are replaced; any other column stays. A NULL
    text weighs nothing; NULL ids and repeated rows are records like any other; an empty
    table gives no rows. The same input falls into the same places, whatever the session's
    number of shuffle partitions.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    weight = docs.agg(F.sum(text_bytes(text) + OVERHEAD)).first()[0] or 0
    n = max(1, -(-weight // bucket_bytes))
    bucket = F.pmod(F.xxhash64("_chance", F.lit(seed + 1)), F.lit(n))
    keyed = _chances(docs, columns, seed).select(bucket.alias("_bucket"), "_chance", "_record")
    counts = stage(keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "shard-buckets")
    # One row per bucket.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    orders = (
        offsets.repartition(n, "_bucket")
        .sortWithinPartitions("_bucket")
        .select("_bucket", "_offset", F.shuffle(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int")), seed).alias("_order"))
    )
    total = counts.agg(F.sum("_n")).first()[0] or 0
    in_bucket = Window.partitionBy("_bucket").orderBy("_chance")
    placed = (
        keyed.repartition(n, "_bucket")
        .withColumn("_rank", F.row_number().over(in_bucket) - 1)
        # A bucket's order meets its records by merging; all orders together grow with the records.
        .join(orders.hint("merge"), "_bucket")
        .withColumn("_place", F.col("_offset") + F.get("_order", F.col("_rank")))
        .select("_place", "_record")
    )
    place, shards, rows = F.col("_place"), F.lit(n_shards).cast("bigint"), F.lit(max(total, 1)).cast("bigint")
    shard = F.expr(f"(_place * {n_shards}) div {max(total, 1)}")
    first = F.floor((F.col("shard") * rows + shards - 1) / shards).cast("bigint")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", place - first)
        .select("_record.*", "shard", "slot")
        .sortWithinPartitions("shard", "slot")
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the records as one folder per shard; files hold them in the order of their slots."""
    shuffled(docs, **options).write.partitionBy("shard").parquet(path)


def op5_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "shards")
    docs = table(spark, sf_dir, "documents")
    write_shards(docs, path)
    written = spark.read.schema("doc_id bigint, text string, slot bigint, shard int").parquet(path)
    return written.select(
        "doc_id", (text_bytes() + OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op5_shuffle_shards": op5_shuffle_shards}
ORACLE: dict[str, str] = {}
