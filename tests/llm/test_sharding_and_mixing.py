"""The sharding operator and the mixing stage against plain versions."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline
from mailweir.llm import cube_mix, shuffle_shards

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(n, words=lambda k: k % 23):
    return [(k, " ".join(f"w{k * j % 97}" for j in range(words(k))), "en", f"s{k % 3}", k) for k in range(n)]


def placed(df, **options):
    return sorted((r["doc_id"] is None, r["doc_id"], r["shard"], r["slot"]) for r in shuffle_shards.shuffled(df, **options).collect())


def test_places_do_not_depend_on_the_session(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame(rows_of(1000) + rows_of(1000)[:200], DOCS).repartition(6).write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in (8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(placed(df, bucket_bytes=5000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_orders_are_not_broadcast(spark):
    df = spark.createDataFrame(rows_of(2000), DOCS)
    plan = shuffle_shards.shuffled(df, bucket_bytes=4000)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_equal_rows_are_spread_over_buckets(spark):
    row = (1, "the same record", "en", "s", 15)
    df = spark.range(100_000).selectExpr(
        "1L AS doc_id", "'the same record' AS text", "'en' AS lang", "'s' AS source", "15L AS n_chars"
    )
    keyed = shuffle_shards._chances(df, df.columns, 5)
    assert keyed.select("_chance").distinct().count() == 100_000
    rows = shuffle_shards.shuffled(df, n_shards=40, bucket_bytes=1 << 16).groupBy("shard").count().collect()
    assert {r["count"] for r in rows} == {2500} and row


def test_a_bucket_is_a_fisher_yates_shuffle_of_its_places(spark):
    """One bucket: the place of a record is what Spark's shuffle gives at its rank by chance."""
    df = spark.createDataFrame(rows_of(300), DOCS)
    chances = {r["_record"]["doc_id"]: r["_chance"] for r in shuffle_shards._chances(df, df.columns, 5).collect()}
    order = spark.range(1, numPartitions=1).selectExpr("shuffle(sequence(0, 299), 5) AS o").first()["o"]
    rank = {d: k for k, d in enumerate(sorted(chances, key=chances.get))}
    rows = shuffle_shards.shuffled(df, n_shards=7).collect()
    first = [-(-s * 300 // 7) for s in range(7)]
    assert sorted(order) == list(range(300))
    assert {r["doc_id"]: first[r["shard"]] + r["slot"] for r in rows} == {d: order[rank[d]] for d in chances}


def test_op5_gives_sizes_and_checksums_of_odd_rows(spark, tmp_path):
    rows = rows_of(200) + [(None, None, None, None, None)] * 3 + [(900, "", "en", "s", 0), (901, "é世 \U0001f600", "en", None, 4), (902, "x" * 200_000, "en", "s", 9)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    found = shuffle_shards.op5_shuffle_shards(spark, str(tmp_path)).collect()
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((i, len(b) + 16, zlib.crc32(b)) for i, b in data)
    assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in found if r["shard"] == s) == list(range(n)) for s, n in counts.items())


@pytest.mark.parametrize("repeated", [False, True])
def test_mixing_takes_each_row_as_often_as_the_mix(spark, tmp_path, repeated):
    rows = rows_of(400, lambda k: 3 + k % 40)
    if repeated:
        rows += rows[:50] + rows[:20] + [(None, "no id here", "fr", None, 1)] * 4 + [(7, None, None, None, None), (8, "", "en", "s0", 0)]
        # The same document twice, from two sources.
        rows += [(5000, "one two three four", "en", s, 18) for s in ("s0", "s1")]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, DOCS).write.parquet(path)
    docs = spark.read.parquet(path)
    mixed = cube_mix.mix(docs.select("source", "text", corpus_pipeline._whole_key().alias("k")), doc_id="k")
    copies = {r["k"]: r["n"] for r in mixed.groupBy(mixed["doc_id"].alias("k")).agg({"copies": "sum"}).toDF("k", "n").collect()}
    keys = {tuple(r)[:-1]: r["k"] for r in docs.withColumn("k", corpus_pipeline._whole_key()).collect()}
    want = Counter({row: copies[k] for row, k in keys.items() if copies[k]})
    assert Counter(map(tuple, corpus_pipeline.mixing(spark, docs, str(tmp_path)).collect())) == want
