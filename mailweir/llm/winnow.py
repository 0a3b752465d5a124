"""Benchmark decontamination by winnowing.

A span of ``window`` words is covered by ``window - K + 1`` k-grams. Of every such row of
k-grams the one with the smallest hash is kept (all of them on a tie), in documents and in
benchmark items alike. Which one that is depends on the span's words only, so a span that
both sides hold has a kept k-gram at the same place in both: none is missed.

Kept k-grams of documents are first looked up in a bitmap of the benchmark's (its size
is fixed; a false hit only costs a row), then joined with them by hash, and each hit is
extended word by word on both sides. Hits whose extension is at least a window long are
exact occurrences.

An item shorter than the window is one window of its own length; each such length, 12 at
most, is winnowed in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import map_batches, plain_words, table
from mailweir.session import stage

WINDOW = 13
#: Words of a k-gram.
K = 5
#: Bits of the bitmap, a power of two: 512 KB.
BITMAP_BITS = 1 << 22
#: Hashes of words a task remembers.
CACHE_WORDS = 300_000

_HIT = pa.struct([
    ("length", pa.int32()), ("pos", pa.int64()), ("hash", pa.int64()),
    ("words", pa.binary()), ("lead", pa.int32()),
])
_HIT_SQL = "array<struct<length int, pos bigint, hash bigint, words binary, lead int>>"
_SPAN = pa.schema([("row", pa.int64()), ("item_id", pa.string()), ("s", pa.int64()), ("e", pa.int64())])


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams."""
    n = len(words) - k + 1
    mixed = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(k):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each stretch of ``width`` values, by doubling."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = pick(values[: len(values) - step], values[step:])
        reach += step
    return values


def winnowed(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest hash of some row of ``width`` k-grams."""
    if len(grams) < width:
        return np.empty(0, np.int64)
    least = _slide(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    most = _slide(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(grams == most)


def _marks(words: list[bytes], hashes: _Hashes, lengths: list[int], bitmap: np.ndarray | None) -> list[tuple]:
    """Kept k-grams, each with the words a window around it can reach."""
    if not words or len(words) < lengths[0]:
        return []
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    found, grams = [], {}
    for length in lengths:
        k = min(K, length)
        if k not in grams:
            grams[k] = _grams(numbers, k)
        places = winnowed(grams[k], length - k + 1)
        values = grams[k][places]
        if bitmap is not None:
            slot = values & np.uint64(BITMAP_BITS - 1)
            hit = (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
            places, values = places[hit == 1], values[hit == 1]
        for at, value in zip(places.tolist(), values.view(np.int64).tolist()):
            lo = max(0, at - (length - k))
            found.append((length, at, value, b" ".join(words[lo : at + length]), at - lo))
    return found


def _fingerprints(df: DataFrame, lengths: list[int], bitmap: bytes | None, own: bool) -> DataFrame:
    """Adds ``n_words, hits`` in place of ``text``; with ``own`` a short text is marked at its
    own length only."""
    kept = [f for f in df.schema if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    hashes = _Hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            counts, hits = [], []
            for value in batch.column("text"):
                words = plain_words(value.as_py())
                counts.append(len(words))
                wanted = [min(len(words), max(lengths))] if own else lengths
                marks = _marks(words, hashes, wanted, bits) if wanted else []
                hits.append([dict(zip(("length", "pos", "hash", "words", "lead"), m)) for m in marks])
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(_HIT))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "n_words", "hits"])

    return df.select(*(f.name for f in kept), "text").mapInArrow(
        run, f"{schema}, n_words bigint, hits {_HIT_SQL}"
    )


def _bitmap(marks: DataFrame) -> bytes:
    """The hashes as a bitmap of fixed size: at most 128 rows of 4 KB reach the driver."""
    slot = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    rows = (
        marks.select(F.bitmap_bucket_number(slot).alias("b"), F.bitmap_bit_position(slot).alias("p"))
        .groupBy("b")
        .agg(F.bitmap_construct_agg("p").alias("bits"))
        .collect()
    )
    whole = bytearray(BITMAP_BITS // 8)
    for row in rows:
        at = (row["b"] - 1) * 4096
        whole[at : at + 4096] = row["bits"]
    return bytes(whole)


def _extend(batch: pa.RecordBatch) -> dict[str, list]:
    """Words two sides share around a k-gram, if they make a window."""
    out: dict[str, list] = {"row": [], "item_id": [], "s": [], "e": []}
    columns = [batch.column(name).to_pylist() for name in batch.schema.names]
    for row, item, length, pos, words, lead, item_words, item_lead in zip(*columns):
        a, b = words.split(), item_words.split()
        left = 0
        while left < min(lead, item_lead) and a[lead - left - 1] == b[item_lead - left - 1]:
            left += 1
        right = 0
        while right < min(len(a) - lead, len(b) - item_lead) and a[lead + right] == b[item_lead + right]:
            right += 1
        if left + right >= length and right >= min(K, length):
            out["row"].append(row)
            out["item_id"].append(item)
            out["s"].append(pos - left)
            out["e"].append(pos + right)
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Which words of each document lie in a window of some benchmark item.

    One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``;
    ``contaminated`` if at least ``percent`` of 100 words are hit. NULL and empty texts have no
    words; items without words mark nothing; items of equal text all count; a NULL
    ``item_id`` counts as one item but has no place in the digest; repeated documents are
    judged one by one and a NULL ``doc_id`` is kept; with an empty benchmark nothing is
    hit. Other columns are not looked at.
    """
    all_lengths = list(range(1, window + 1))
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    marks = stage(
        _fingerprints(items, all_lengths, None, True)
        .select("item_id", F.inline("hits"))
        .select("item_id", "length", "hash", F.col("words").alias("item_words"), F.col("lead").alias("item_lead"))
        .distinct(),
        "winnow-marks",
    )
    lengths = sorted(r[0] for r in marks.select("length").distinct().collect())  # at most `window`
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    found = stage(_fingerprints(numbered, lengths, _bitmap(marks), False), "winnow-hits")
    hits = found.select("row", F.inline("hits"))
    pairs = hits.join(marks, ["length", "hash"]).select(
        "row", "item_id", "length", "pos", "words", "lead", "item_words", "item_lead"
    )
    spans = stage(
        map_batches(pairs, _extend, "row bigint, item_id string, s bigint, e bigint", _SPAN).distinct(),
        "winnow-spans",
    )
    before = Window.partitionBy("row").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        spans.select("row", "s", "e")
        .distinct()
        .withColumn("from", F.greatest("s", F.coalesce(F.max("e").over(before), F.lit(0))))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.col("from"))).alias("n_hit"))
    )
    ids = F.array_join(F.sort_array(F.collect_list("item_id")), ",")
    named = (
        spans.select("row", "item_id")
        .distinct()
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sha2(ids, 256).alias("items_sha256"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        found.select("row", "doc_id", "n_words")
        .join(covered.join(named, "row"), "row", "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
        )
    )


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Windows of items as strings of words between spaces, looked up among the documents' own.
_WORDS = "list_filter(regexp_split_to_array(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

ORACLE = {
    "op7_winnowing": f"""
WITH doc AS (SELECT doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
item AS (SELECT item_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
place AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, place.n, i, item_id FROM place JOIN win USING (g) WHERE place.n = win.n),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
covered AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
}
QUERIES = {"op7_winnowing": op7_winnowing}
