"""An index of the ids a mail table holds, filed by hash, beside the table.

``<table>-ids/gen-<n>/ids/bucket=<b>`` holds the ids of a bucket, each with the load that brought
it, and ``filters`` one bitmap of fixed size per bucket and load. An id whose bit is not set in
its bucket's bitmap is not stored; for the others only their buckets are opened, so what a
small batch reads follows the batch and not the store.

A load notes that it begins, writes its ids, then its rows, then that it is settled. If it breaks
off in between, the next one looks its ids up in the table itself, files those that are there
again, and sets the load aside. So no message is taken for stored that is not, and none is
stored twice. As the table, the index has one writer at a time.

``digests`` hold a count and hashes per bucket and load, so that two tables are compared bucket
by bucket, and only ids of buckets that differ are read.

``compact`` writes all ids into a new generation, which counts from the moment its mark is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.session import stage
from mailweir.sources.files import create, names, path_exists, remove
from mailweir.sources.tables import id_home, read_mail

#: Buckets of ids; each is one folder, and one bitmap of 4 KB in the filter.
BUCKETS = 256
#: Bits of Spark's bitmaps, a fixed value.
BITS = 32_768

_IDS = "id string, load string, bucket int"
_FILTERS = "bucket int, bits binary"
_DIGESTS = "bucket int, load string, n bigint, one bigint, two bigint"


def _generation(spark: SparkSession, table: str) -> int | None:
    ready = names(spark, id_home(table), "ready-")
    return max(map(int, ready)) if ready else None


def _folder(spark: SparkSession, table: str) -> str:
    return f"{id_home(table)}/gen-{_generation(spark, table)}"


def exists(spark: SparkSession, table: str) -> bool:
    return _generation(spark, table) is not None


def _bucket() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")


def _bit() -> Column:
    return F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(BITS))


def _record(ids: DataFrame, folder: str, load: str) -> None:
    rows = stage(ids.select("id", F.lit(load).alias("load"), _bucket().alias("bucket")), "index-ids")
    rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{folder}/ids")
    bits = rows.groupBy("bucket").agg(F.bitmap_construct_agg(_bit()).alias("bits"))
    bits.coalesce(1).write.mode("append").parquet(f"{folder}/filters")
    hashes = [F.bit_xor(F.xxhash64(F.lit(k), "id")).alias(name) for k, name in ((2, "one"), (3, "two"))]
    sums = rows.groupBy("bucket", "load").agg(F.count(F.lit(1)).alias("n"), *hashes)
    sums.coalesce(1).write.mode("append").parquet(f"{folder}/digests")


def _generate(spark: SparkSession, table: str, ids: DataFrame) -> None:
    """Write a generation of the index, let it count, and remove those before it."""
    old = names(spark, id_home(table), "gen-")
    now = max(map(int, old), default=0) + 1
    folder = f"{id_home(table)}/gen-{now}"
    _record(ids, folder, "base")
    create(spark, f"{folder}/begun/base")
    create(spark, f"{folder}/settled/base")
    create(spark, f"{id_home(table)}/ready-{now}")
    for n in old:
        remove(spark, f"{id_home(table)}/ready-{n}")
        remove(spark, f"{id_home(table)}/gen-{n}")


def build(spark: SparkSession, table: str) -> None:
    """Make the index of a table, from the ids in it."""
    _generate(spark, table, read_mail(spark, table).filter("id is not null").select("id").distinct())


def compact(spark: SparkSession, table: str) -> None:
    """Merge the files of all loads."""
    recover(spark, table)
    _generate(spark, table, stage(entries(spark, table).select("id").distinct(), "index-all"))


def _settled(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    """A part of the index without loads that broke off and those set aside; both are rare."""
    path = f"{folder}/{part}"
    rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    out = (names(spark, f"{folder}/begun") - names(spark, f"{folder}/settled")) | names(spark, f"{folder}/void")
    return rows.filter(~F.col("load").isin(sorted(out))) if out else rows


def entries(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame:
    """``id, load, bucket`` of settled loads, of all buckets or some."""
    rows = _settled(spark, _folder(spark, table), "ids", _IDS)
    if buckets is None:
        return rows
    return rows.filter(F.col("bucket").isin(buckets)) if buckets else spark.createDataFrame([], _IDS)


def digests(spark: SparkSession, table: str) -> DataFrame:
    """``bucket, n, one, two``: how many ids a bucket has, and two hashes of them in any order.

    Every load files its own; together they are those of all ids, since a load brings new ids only.
    """
    rows = _settled(spark, _folder(spark, table), "digests", _DIGESTS)
    return rows.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two")
    )


def differing(spark: SparkSession, a: str, b: str) -> list[int]:
    """Buckets in which two tables with indexes hold different ids; from digests, no id is read.

    Should an id be filed twice, after a load that broke off twice, its bucket is named too.
    """
    both = digests(spark, a).withColumn("side", F.lit(1)).unionByName(digests(spark, b).withColumn("side", F.lit(2)))
    seen = both.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sides"), F.count_distinct("n", "one", "two").alias("kinds")
    )
    # At most BUCKETS numbers.
    return sorted(r[0] for r in seen.filter("sides < 2 or kinds > 1").select("bucket").collect())


def _asked(spark: SparkSession, table: str, ids: DataFrame) -> DataFrame:
    """Those of the ids that the filter does not rule out, with their buckets."""
    path = f"{_folder(spark, table)}/filters"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id string, bucket int")
    # One bitmap per bucket: BUCKETS rows of 4 KB.
    filters = spark.read.schema(_FILTERS).parquet(path).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = ids.select("id").filter("id is not null").distinct().withColumns({"bucket": _bucket(), "_bit": _bit()})
    byte = F.conv(F.hex(F.expr("substring(bits, int(_bit div 8) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, int(_bit % 8)) & 1") == 1
    joined = asked.join(F.broadcast(filters), "bucket").withColumn("_byte", byte)
    return joined.filter(is_set).select("id", "bucket")


def hits(spark: SparkSession, table: str, ids: DataFrame) -> DataFrame:
    """Which of the ids are stored, each once. Opens the buckets that may hold them."""
    asked = stage(_asked(spark, table, ids), "index-asked")
    # At most BUCKETS numbers.
    opened = sorted(r[0] for r in asked.select("bucket").distinct().collect())
    found = entries(spark, table, opened).select("bucket", "id")
    return found.join(asked, ["bucket", "id"], "left_semi").select("id").distinct()


def recover(spark: SparkSession, table: str) -> list[str]:
    """Settle loads that broke off, by what the table has of their ids; their names."""
    folder = _folder(spark, table)
    done = names(spark, f"{folder}/settled") | names(spark, f"{folder}/void")
    broken = sorted(names(spark, f"{folder}/begun") - done)
    if not broken:
        return []
    if path_exists(spark, f"{folder}/ids"):
        rows = spark.read.schema(_IDS).parquet(f"{folder}/ids")
        unsure = rows.filter(F.col("load").isin(broken)).select("id").distinct()
        stored = read_mail(spark, table).select("id").join(unsure, "id", "left_semi").distinct()
        appended(spark, table, stored, lambda: 0)
    for load in broken:
        create(spark, f"{folder}/void/{load}")
    return broken


def appended(spark: SparkSession, table: str, ids: DataFrame, write: Callable[[], int]) -> int:
    """File the ids, then write the rows; what ``write`` returns."""
    folder, load = _folder(spark, table), uuid.uuid4().hex
    create(spark, f"{folder}/begun/{load}")
    _record(ids, folder, load)
    written = write()
    create(spark, f"{folder}/settled/{load}")
    return written
