"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector in its upper four bits and, below, as many ids as fit at
the width the selector names. An id of 60 bits or more, or one that looks like the mark, is
an escape: its word is selector 15 with all 60 bits set, and the id itself stands in the
block's escape list. Packing takes, at each place, the selector that holds most ids.

The files are Parquet, so any store Spark reaches will do. One row is a block:

``shard``     number of the file's range of documents, ascending with ``doc_id``
``block``     number of the block in its shard
``base``      ids in this shard before the block
``doc_ids``   documents of the block, whole ones, in order
``lengths``   their ids
``n_ids``     ids of the block
``words``     the 64-bit words, little-endian
``escapes``   the escaped ids, 64-bit little-endian
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import table, text_or_empty
from mailweir.session import run_dir

# Ids per word and bits per id of each selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

ESCAPE = (1 << 60) - 1
#: Ids gathered before a block is closed; documents are never cut.
BLOCK_IDS = 1 << 17
#: Words whose ids a task remembers, and bytes of text it encodes at a time.
CACHE_WORDS = 500_000
PIECE_BYTES = 12 << 20
# What may follow the letters of a word: no apostrophe, which the tokenizer joins with some letters.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)

# The normalizer, pre-tokenizer and word end of tokenizers that work word by word.
_BY_WORDS = [
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "</w>",
]

BLOCKS = (
    "shard int, block int, base bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "n_ids bigint, words binary, escapes binary"
)
_BLOCKS = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("base", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("words", pa.binary()), ("escapes", pa.binary()),
])


def _longest(bits: np.ndarray) -> np.ndarray:
    """For each place the selector that holds most ids from there on."""
    n = len(bits)
    best = np.full(n, 15, np.uint8)
    widest, reach = bits, 1
    for selector in range(14, -1, -1):
        count = COUNTS[selector]
        if count > n:
            break
        # The widest of the next `count` ids, from two overlapping shorter stretches.
        while reach < count:
            step = min(reach, count - reach)
            widest = np.maximum(widest[: len(widest) - step], widest[step:])
            reach += step
        fits = widest <= WIDTHS[selector]
        best[: len(fits)][fits] = selector
    return best


def pack(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Unsigned ids to words and escapes."""
    ids = ids.astype(np.uint64, copy=False)
    if not len(ids):
        return b"", b""
    escaped = ids >= ESCAPE
    escapes = ids[escaped]
    if len(escapes):
        ids = np.where(escaped, np.uint64(ESCAPE), ids)
    # Doubles hold the exponent of any integer; near 2^53 it may be one too large, never too small.
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    bits = np.minimum(bits, 60)
    best = _longest(bits)
    steps = np.array(COUNTS, np.int64)[best].tolist()
    starts, at, end = [], 0, len(steps)
    while at < end:
        starts.append(at)
        at += steps[at]
    where = np.array(starts, np.int64)
    chosen = best[where]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        width, count = WIDTHS[selector], COUNTS[selector]
        if width:
            mine = np.flatnonzero(chosen == selector)
            taken = ids[where[mine][:, None] + np.arange(count)]
            shifts = (np.arange(count) * width).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(taken << shifts, axis=1)
    return words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()


def unpack(words: bytes, escapes: bytes, n_ids: int) -> np.ndarray:
    """The ids of a block, all words of one selector at a time."""
    packed = np.frombuffer(words, "<u8")
    selectors = (packed >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, np.int64)[selectors]
    ends = np.cumsum(counts)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        width, count = WIDTHS[selector], COUNTS[selector]
        if width:
            mine = np.flatnonzero(selectors == selector)
            shifts = (np.arange(count) * width).astype(np.uint64)
            values = (packed[mine][:, None] >> shifts) & np.uint64((1 << width) - 1)
            ids[(ends[mine] - count)[:, None] + np.arange(count)] = values
    ids = ids[:n_ids]
    if escapes:
        ids[ids == ESCAPE] = np.frombuffer(escapes, "<u8")
    return ids


def _listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


class _Encoder:
    """Ids of texts, with the words met so far remembered.

    The tokenizer lower-cases, drops white space and cuts at the border of letters and other
    characters, so a text's ids are those of its pieces between spaces and line feeds, and a
    word's are those of its letters and of the marks behind them. Texts are cut and their
    distinct pieces found by Arrow. Runs of letters are new most often; they are encoded
    many at a time and told apart by the ids that end a word. Anything unusual inside a
    piece (digits, an apostrophe, rarer white space) is left to the tokenizer as it stands.

    That holds for tokenizers whose file says so; with any other one texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        said = [spec["normalizer"], spec["pre_tokenizer"], spec["model"].get("end_of_word_suffix")]
        self.by_words = said == _BY_WORDS
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.letters: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}

    def _plainly(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn_letters(self, words: list[str]) -> None:
        for lo in range(0, len(words), 1000):
            some = words[lo : lo + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids):
                data, edges = ids.tobytes(), [0, *(4 * stops).tolist()]
                self.letters.update((w, data[x:y]) for w, x, y in zip(some, edges, edges[1:]))
            else:
                self.letters.update(zip(some, self._plainly(some)))

    def _ids_of(self, pieces: list[str], letters: list[bool]) -> list[bytes]:
        for store in (self.letters, self.whole):
            if len(store) > CACHE_WORDS:
                store.clear()
        self._learn_letters([x for x, plain in zip(pieces, letters) if plain and x not in self.letters])
        new = [x for x, plain in zip(pieces, letters) if not plain and x not in self.whole]
        self.whole.update(zip(new, self._plainly(new)))
        return [self.letters[x] if plain else self.whole[x] for x, plain in zip(pieces, letters)]

    def _cut(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of all pieces, the last of which is empty, and each word's two pieces."""
        # Some letters depend on their place when lowered, special tokens on their case: left alone.
        kept = pc.match_substring_regex(words, "[\u03a3\u0130]|<\\|")
        lowered = pc.if_else(kept, words, pc.utf8_lower(words))
        core = pc.utf8_rtrim(lowered, characters=_MARKS)
        plain = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring(core, "\u0130")))
        first = pc.if_else(plain, core, lowered).dictionary_encode()
        longer = np.flatnonzero(pc.not_equal(pc.binary_length(lowered), pc.binary_length(first.cast(pa.string()))))
        rows = pa.array(longer)
        lengths = _listed(pc.utf8_length(core.take(rows)))
        marks = pa.array([w[n:] for w, n in zip(_listed(lowered.take(rows)), lengths)], pa.string()).dictionary_encode()
        names = first.dictionary
        letters = pc.and_(pc.utf8_is_alpha(names), pc.invert(pc.match_substring(names, "\u0130")))
        found = self._ids_of(_listed(names), _listed(letters))
        found += self._ids_of(_listed(marks.dictionary), [False] * len(marks.dictionary))
        second = np.full(len(words), len(found), np.int64)
        second[longer] = marks.indices.to_numpy(zero_copy_only=False) + len(names)
        return [*found, b""], first.indices.to_numpy(zero_copy_only=False), second

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if not self.by_words:
            found = self._plainly(texts.to_pylist())
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        found, first, second = self._cut(coded.dictionary)
        pieces = np.stack([first[place], second[place]], axis=1).ravel()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        each = sizes[pieces]
        ends = np.cumsum(each)
        where = np.repeat(starts[pieces] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)
        words = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], ends])[2 * np.cumsum(words)]
        return np.frombuffer(b"".join(found), "<u4")[where], np.diff(upto, prepend=0)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of bounded text, a text at least."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, before + PIECE_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id",
    text: str = "text", block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts and write their ids, in ascending ``doc_id`` order, as block files.

    A NULL text is empty and has only the end id. A NULL ``doc_id`` comes first; rows of equal
    ``doc_id`` follow each other in the order of their texts. An empty table gives no block.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        block = base = held = 0
        names: list = []
        ids: list[bytes] = []

        def close() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in ids]
            words, escapes = pack(np.frombuffer(b"".join(ids), "<u4"))
            row = [shard], [block], [base], [names], [lengths], [held], [words], [escapes]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, _BLOCKS)], schema=_BLOCKS
            )

        for piece in (p for batch in batches for p in _pieces(batch)):
            found, sizes = encoder.encode(piece.column("text"))
            data, at = memoryview(found.astype("<u4").tobytes()), 0
            for name, n in zip(piece.column("doc_id").to_pylist(), sizes.tolist()):
                names.append(name)
                ids.append(b"".join((data[at : at + 4 * n], end)))
                at += 4 * n
                held += n + 1
                if held >= block_ids:
                    yield close()
                    block, base, held, names, ids = block + 1, base + held, 0, [], []
        if names:
            yield close()

    ordered.mapInArrow(encode, BLOCKS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back: ``doc_id, start, n_tokens, ids_crc32, shard, block``."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    # One row per file range, as many as the writer had tasks.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("offset"))
    found = pa.schema([
        ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()), ("shard", pa.int32()), ("block", pa.int32()),
    ])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                ids = unpack(row["words"], row["escapes"], row["n_ids"]).astype("<u4")
                data = memoryview(ids.tobytes())
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                n = len(lengths)
                columns = (
                    row["doc_ids"], ends - lengths + row["base"], lengths, crc,
                    [row["shard"]] * n, [row["block"]] * n,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(columns, found)], schema=found
                )

    rows = blocks.mapInArrow(
        decode, "doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint, shard int, block int"
    )
    return rows.join(offsets, "shard").select(
        "doc_id", (F.col("within") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
        "shard", "block",
    )


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = run_dir(spark, "simple8b")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path)


QUERIES = {"op2_simple8b": op2_simple8b}
ORACLE: dict[str, str] = {}
