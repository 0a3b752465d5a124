"""From raw documents to shards: five stages, each written as Parquet and read by the next.

1. quality: documents that the classifier rejects go.
2. near duplicates: one document of each group stays (five words, 0.8).
3. decontamination: documents that hold benchmark passages go.
4. mixing: documents are left out or repeated to meet the sources' weights.
5. sharding: what is left is shuffled into shards.

Every stage looks at all rows of its predecessor. All but the last return the columns of
``documents``; other columns of the input are dropped. A row is identified by its
``doc_id`` and its text, so NULL and repeated ids do no harm. An empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.common import DOCUMENT, table
from mailweir.llm.cube_mix import mix
from mailweir.llm.pu_quality import train, with_score
from mailweir.llm.shuffle_shards import shuffled
from mailweir.llm.signature_tree import one_of_each
from mailweir.llm.winnow import contamination
from mailweir.session import run_dir, stage

SHARDS = 40


def _key() -> Column:
    """Id and text of a row in one string."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.concat(doc_id, F.lit(":"), F.hex(F.xxhash64(F.coalesce("text", F.lit("")))))


def _whole_key() -> Column:
    """Rows that have it in common are alike in all columns."""
    return F.concat(_key(), F.lit(":"), F.hex(F.xxhash64("lang", "source", "n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts."""
    docs = docs.select(*DOCUMENT)
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model, name="_score").filter("_score >= 0.5").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies."""
    return one_of_each(docs.select(*DOCUMENT))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark passages."""
    keyed = docs.select(*DOCUMENT, _key().alias("_key"))
    judged = contamination(keyed, table(spark, sf_dir, "benchmark"), doc_id="_key")
    bad = judged.filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(bad, "_key", "left_anti").select(*DOCUMENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes of it; rows without words are not in it.

    Only ids and hashes are mixed and counted. The texts are read once, dealt by hash and meet
    their number of copies in a hash table of those narrow rows, so no text is sorted.
    """
    docs = docs.select(*DOCUMENT)
    mixed = mix(docs.select("source", "text", _whole_key().alias("_key")), doc_id="_key")
    taken = mixed.groupBy(F.col("doc_id").alias("_key")).agg(
        F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    ).filter("_copies > 0")
    taken = stage(taken, "pipeline-copies")
    keyed = docs.withColumn("_key", _whole_key()).join(taken.hint("shuffle_hash"), "_key")
    single = keyed.filter("_rows = 1").select(*DOCUMENT, "_copies")
    # Rows that are alike take their copies together.
    alike = keyed.filter("_rows > 1").groupBy(*DOCUMENT).agg(F.max("_copies").alias("_copies"))
    once = single.unionByName(alike) if taken.filter("_rows > 1").limit(1).count() else single
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*DOCUMENT)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in their shards' order, with ``shard`` and ``slot``."""
    return shuffled(docs.select(*DOCUMENT), n_shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A learned score and a random mix are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        path = run_dir(spark, f"pipeline-{name}")
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
