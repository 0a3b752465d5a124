"""Two tokenizers' tokens of the same texts, aligned, with corpus-wide counts of linked ids.

Texts are shuffled by their whole text, so that each distinct one is tokenised and aligned once
and carries the number of its copies. Byte offsets at which tokens of both end cut a text
into groups; tokens of a group are linked. A pair of ids counts once for every document that
links it, copies included. The counts are joined back to the texts and these to the rows.

Inside a task, texts are cut where neither tokenizer's tokens cross (``chunks``), and each
batch's distinct chunks are aligned at once in arrays. Pairs of the highest counts, a fixed
number of them, are sent to every task; all others are joined by a shuffle, so both the
rows to move and the largest group of them stay small, and no pair is left out.

The first tokenizer is byte-level BPE (``tokenizers``), the second BPE with byte fallback
(``piece_table``). A text that is NULL, empty, or whose tokens do not spell a space and the text
has no tokens, and zeros. Rows are kept as they are, NULL and repeated doc_ids too; other
columns are dropped; an empty table gives none. Texts of any length are aligned whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.chunks import bounded, cut, ragged
from mailweir.llm.common import table
from mailweir.llm.piece_table import piece_table
from mailweir.session import stage

#: Pairs of highest counts that every task gets, 17 bytes each.
HOT_PAIRS = 1 << 16
#: Bytes of text that are aligned at a time; a task holds some 40 times as much.
ALIGN_BYTES = 4 << 20

_ALIGNED = pa.schema([
    ("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int32())]))),
])
# How byte-level BPE cuts texts into words, and words of settled characters.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COMMON = r"\A [!-~\x{a1}-\x{ac}\x{ae}-\x{24f}]+\z"
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Aligner:
    """Both tokenizers and what is needed to write their tokens."""

    def __init__(self, byte_bpe: str, pieces: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        spec = json.loads(self.a.to_str())
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{byte_bpe} is no plain byte-level tokenizer")
        self.b = piece_table(pieces)
        self.whole = self.b.whole or not before.get("use_regex", True)
        self.fast = self._ranked(spec["model"]) if not self.whole else None
        letter = _letters()
        n = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(n)]
        self.a_bytes = pa.array([bytes(letter.get(c, 0) for c in name) for name in names], pa.binary())
        self.b_bytes = pa.array(self.b.values, pa.binary())
        self.a_sizes = pc.binary_length(self.a_bytes).to_numpy().astype(np.int64)
        self.b_sizes = pc.binary_length(self.b_bytes).to_numpy().astype(np.int64)
        # A token in a group's text: followed by one of its side, or by the other side or group.
        self.n_a = n
        written = [f"{i}{mark}" for mark in ",|" for i in range(n)]
        written += [f"{i}{mark}" for mark in ",;" for i in range(len(self.b.values))]
        self.written = pa.array(written, pa.string())

    def _ranked(self, model: dict):
        """The same tokenizer by ranks, if merges come in the order of their ids: it is much faster."""
        import tiktoken

        vocabulary, letter = model["vocab"], _letters()
        merged = [vocabulary[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        if merged != sorted(merged) or len(set(merged)) < len(merged):
            return None
        made = {vocabulary[c] for c in letter} | set(merged)
        ranks = {bytes(letter[c] for c in name): i for name, i in vocabulary.items() if i in made}
        return tiktoken.Encoding("byte_bpe", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def byte_tokens(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Byte-level ids of chunks one after the other, and their numbers.

        Words of letters and marks that all versions of Unicode class alike are encoded in one
        string, which their leading spaces cut; the others one by one by the library of the file.
        """
        n = np.zeros(len(chunks), np.int64)
        common = np.zeros(len(chunks), bool)
        ids = np.zeros(0, np.int64)
        if self.fast is not None:
            common = pc.match_substring_regex(chunks, _COMMON).to_numpy(zero_copy_only=False)
            words = chunks.filter(pa.array(common))
            ids = self.fast.encode_to_numpy("".join(words.to_pylist()), disallowed_special=()).astype(np.int64)
            ends = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64))
            upto = np.searchsorted(np.cumsum(self.a_sizes[ids]), ends) + 1
            n[common] = np.diff(upto, prepend=0)
        rest = chunks.filter(pa.array(~common)).to_pylist()
        found = [e.ids for e in self.a.encode_batch_fast(rest, add_special_tokens=False)]
        n[~common] = list(map(len, found))
        starts = np.zeros(len(chunks), np.int64)
        starts[common] = np.cumsum(n[common]) - n[common]
        starts[~common] = np.cumsum(n[~common]) - n[~common] + len(ids)
        more = np.fromiter((i for x in found for i in x), np.int64, int(n[~common].sum()))
        return np.concatenate([ids, more])[ragged(starts, n)], n

    def tokens(self, chunks: pa.Array) -> tuple[np.ndarray, ...]:
        """Ids of chunks and their numbers, by either tokenizer; none where bytes differ."""
        ids_a, n_a = self.byte_tokens(chunks)
        ids_b, n_b = self.b.encode_chunks(chunks)
        ids_b = ids_b.astype(np.int64)
        data = chunks.cast(pa.binary())
        good = np.ones(len(chunks), bool)
        for ids, n, values in ((ids_a, n_a, self.a_bytes), (ids_b, n_b, self.b_bytes)):
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            spelled = pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(ids))), b"")
            good &= pc.equal(spelled, data).to_numpy(zero_copy_only=False)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        return ids_a, n_a, ids_b, n_b, good

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        numbers, offsets, chunks = cut(texts, self.whole)
        ids_a, n_a, ids_b, n_b, good = self.tokens(chunks)
        n_chunks, n_texts = len(chunks), len(texts)
        # Ends in bytes over all chunks; chunks end alike on both sides, so none share a group.
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        shared_a = _within(ends_a, ends_b)
        shared_b = _within(ends_b, ends_a)
        group_a = np.cumsum(shared_a) - shared_a
        group_b = np.cumsum(shared_b) - shared_b
        groups = int(shared_a.sum())
        per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        chunk_of_a = np.repeat(np.arange(n_chunks), n_a)
        chunk_of_group = chunk_of_a[shared_a]
        n_groups = np.bincount(chunk_of_group, minlength=n_chunks)
        n_links = np.bincount(chunk_of_group, weights=per_a * per_b, minlength=n_chunks).astype(np.int64)
        # The groups' text: tokens in order of group and side, each with the mark behind it.
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
        marked = np.concatenate([
            ids_a + self.n_a * last_a, 2 * self.n_a + ids_b + len(self.b_sizes) * shared_b,
        ])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        words = self.written.take(pa.array(marked[order]))
        upto = pa.array(np.concatenate([[0], np.cumsum(n_a + n_b)]), pa.int32())
        said = pc.binary_join(pa.ListArray.from_arrays(upto, words), "")
        # Links of a chunk: each token of one side with all of its group on the other.
        fan = per_b[group_a]
        starts_b = np.cumsum(per_b) - per_b
        pairs = np.repeat(ids_a, fan) << 32 | ids_b[ragged(starts_b[group_a], fan)]
        kinds, coded = np.unique(pairs, return_inverse=True)
        first = np.cumsum(n_links) - n_links
        # From chunks to texts; a text with a chunk that is spelled otherwise has nothing.
        owner = np.repeat(np.arange(n_texts), np.diff(offsets))
        fine = np.bincount(owner, weights=~good[numbers], minlength=n_texts) == 0
        keep = fine[owner]
        numbers, owner = numbers[keep], owner[keep]

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, weights=values[numbers], minlength=n_texts).astype(np.int64)

        per_text = np.bincount(owner, minlength=n_texts)
        edges = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(edges, said.take(pa.array(numbers))), "")
        fan = n_links[numbers]
        size = max(1, len(kinds))
        met = np.repeat(owner * size, fan)
        met += coded[ragged(first[numbers], fan)]
        met, times = np.unique(met, return_counts=True)
        where, ids = met // size, kinds[met % size]
        lists = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=n_texts))])
        links = pa.StructArray.from_arrays(
            [pa.array(x, pa.int32()) for x in (ids >> 32, ids & 0xFFFFFFFF, times)],
            fields=list(_ALIGNED.field("links").type.value_type),
        )
        return {
            "n_a": summed(n_a), "n_b": summed(n_b), "n_groups": summed(n_groups), "n_links": summed(n_links),
            "groups": pc.utf8_rtrim(joined, ";"),
            "links": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), links),
        }


def _within(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of some ascending numbers are among others."""
    if not len(others):
        return np.zeros(len(some), bool)
    return others[np.minimum(np.searchsorted(others, some), len(others) - 1)] == some


@lru_cache(maxsize=1)
def _aligner(byte_bpe: str, pieces: str) -> _Aligner:
    return _Aligner(byte_bpe, pieces)


def aligned_texts(docs: DataFrame, byte_bpe: str, pieces: str, text: str = "text") -> DataFrame:
    """Every distinct text that is not empty: ``key, copies, n_a, n_b, n_groups, n_links, groups, links``.

    ``key`` is the text's SHA-256, ``copies`` the number of its rows. ``groups`` reads
    ``a1,a2|b1;a3|b2,b3``; ``links`` are the distinct linked ids and their occurrences.
    """
    texts = (
        docs.select(F.col(text).alias("text")).filter("text <> ''")
        .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        .select(_key("text").alias("key"), "copies", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_bpe, pieces)
        for part in (p for batch in batches for p in bounded(batch, most=ALIGN_BYTES)):
            found = aligner.align(part.column("text")) | {n: part.column(n) for n in ("key", "copies")}
            columns = [found[f.name] for f in _ALIGNED]
            columns = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _ALIGNED)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)
            del found, columns
            pa.default_memory_pool().release_unused()

    return texts.mapInArrow(
        run, "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups string, links array<struct<a: int, b: int, times: int>>"
    )


def _key(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(text, "utf-8"), 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that link two ids, and whether no id is linked to ``a`` by more."""
    counts = stage(
        aligned.select("copies", F.inline("links")).groupBy("a", "b").agg(F.sum("copies").alias("count")),
        "pair-counts",
    )
    most = counts.groupBy("a").agg(F.max("count").alias("_most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))


def _scores(aligned: DataFrame, counts: DataFrame, hot_pairs: int) -> DataFrame:
    """``_no, n_best, count_sum`` of each text that has links."""
    rows = aligned.select("_no", F.inline("links"))
    hot = stage(counts.orderBy(F.desc("count"), "a", "b").limit(hot_pairs), "hot-pairs")
    per_text = (
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    common = rows.join(F.broadcast(hot), ["a", "b"]).groupBy("_no").agg(*per_text)
    others = rows.join(F.broadcast(hot), ["a", "b"], "left_anti").join(counts, ["a", "b"])
    both = common.unionByName(others.groupBy("_no").agg(*per_text))
    return both.groupBy("_no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame, byte_bpe: str, pieces: str, doc_id: str = "doc_id", text: str = "text",
    groups: Callable[[Column], Column] = lambda g: g, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row.

    ``n_best`` are the links whose pair counts most for its first id, ``count_sum`` the counts
    over all links. ``groups`` says what of the groups' text to keep, the whole by default.
    """
    aligned = aligned_texts(docs, byte_bpe, pieces, text)
    kept = aligned.withColumn("groups", groups(F.col("groups"))).withColumn("_no", F.monotonically_increasing_id())
    kept = stage(kept, "aligned")
    counts = stage(pair_counts(kept), "scored-pairs")
    scores = _scores(kept, counts, hot_pairs)
    measures = stage(
        kept.select("key", "_no", *_MEASURES, "groups").join(scores, "_no", "left").drop("_no"), "measures"
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), _key(text).alias("key"))
    zero = [F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in (*_MEASURES, "n_best", "count_sum")]
    return rows.join(measures, "key", "left").select(
        "doc_id", *zero, F.coalesce("groups", F.lit("")).alias("groups")
    )


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and piece tokens of every document."""
    import public_tokenizers

    def digest(groups: Column) -> Column:
        return F.when(groups == "", "").otherwise(F.sha2(F.encode(groups, "utf-8"), 256))

    found = align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), groups=digest,
    )
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *_MEASURES, "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


QUERIES = {"op13_token_align": op13_token_align}
ORACLE: dict[str, str] = {}
