"""All maximal periodic runs of words in every text, by longest common extensions.

A run of period q is a stretch in which words q apart are the same and that no neighbour extends.
A run at least twice as long as its period has a Lyndon root: a word that is less than all of its
own suffixes, in the order of words or in the opposite one, and that is the longest such word at
its place. So the longest Lyndon words at all places, in both orders, are the candidates, two a
place, and each is extended both ways by the longest common extension of its two ends.

Extensions are lowest common ancestors in Ukkonen's suffix trees of the words and of their
reversal: an Euler tour lists the depths of the nodes met, and the least depth between two
leaves, read from two overlapping power-of-two stretches of the tour, is the extension. The
order of suffixes, from which the Lyndon words follow, is the order of the same tree's leaves.

Trees are built of those stretches of a text that a run may lie in: at least twice its period and
``MIN_LENGTH`` words long, a run consists of windows of ``MIN_LENGTH / 2`` words that stand in
the text again, so places outside all such windows belong to none and no run crosses them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.chunks import bounded
from mailweir.llm.common import table, text_or_empty
from mailweir.session import spread

#: Words a run has at least.
MIN_LENGTH = 12

Runs = list[tuple[int, int, int]]


class SuffixTree:
    """Ukkonen's suffix tree of numbers from 0 up; an end mark less than all is added."""

    def __init__(self, values: list[int]):
        text = [v + 1 for v in values] + [0]
        n = len(text)
        width = max(text) + 1
        # Node 0 is the root. An edge is named by the node it leads to: its first place and end.
        first, end, link = [0] * (2 * n + 1), [n] * (2 * n + 1), [0] * (2 * n + 1)
        nodes = 1
        edges: dict[int, int] = {}
        node = edge = length = remain = 0
        for i, symbol in enumerate(text):
            remain += 1
            waiting = 0
            while remain:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = nodes
                    first[nodes] = i
                    nodes += 1
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    span = (end[child] if end[child] < i + 1 else i + 1) - first[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[first[child] + length] == symbol:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = nodes
                    nodes += 2
                    start = first[split] = first[child]
                    start += length
                    end[split] = first[child] = start
                    edges[key] = split
                    edges[split * width + symbol] = split + 1
                    first[split + 1] = i
                    edges[split * width + text[start]] = child
                    if waiting:
                        link[waiting] = split
                    waiting = split
                remain -= 1
                if not node and length:
                    length -= 1
                    edge = i - remain + 1
                elif node:
                    node = link[node]
        self.n = n
        parents, symbols = np.divmod(np.fromiter(edges, np.int64, len(edges)), width)
        children = np.fromiter(edges.values(), np.int64, len(edges))
        edges.clear()
        size = np.array(end[:nodes]) - np.array(first[:nodes])
        size[0] = 0
        order = np.lexsort((symbols, parents))
        self.parents, self.symbols, self.children = parents[order], symbols[order], children[order]
        self.begin = np.searchsorted(self.parents, np.arange(len(size) + 1))
        self.is_leaf = self.begin[1:] == self.begin[:-1]
        # Suffixes get their leaves in order.
        self.suffix = np.cumsum(self.is_leaf) - 1
        self._tour(size)

    def _tour(self, size: np.ndarray) -> None:
        """The Euler tour, of which the least depth between neighbouring leaves is kept."""
        parent = np.zeros(len(size), np.int64)
        parent[self.children] = self.parents
        depth, at = size, parent
        # Depths by doubling: each round adds what is known of the ancestor reached so far.
        while at.any():
            depth, at = depth + depth[at], at[at]
        # Entering another child than the first, the tour has just been at its parent.
        turn = np.full(len(size), -1, np.int64)
        later = np.flatnonzero(self.parents[1:] == self.parents[:-1]) + 1
        turn[self.children[later]] = depth[self.parents[later]]
        leaves, least, low = [], [], 0
        kids, lo, hi, turn = self.children[::-1].tolist(), *self._ranges(), turn.tolist()
        path = [0]
        while path:
            node = path.pop()
            if turn[node] >= 0:
                low = turn[node]
            if lo[node] == hi[node]:
                leaves.append(node)
                least.append(low)
            else:
                path += kids[lo[node] : hi[node]]
        #: Suffixes in order, the end mark's first, and each one's extension common with the one before.
        self.order = self.suffix[leaves]
        self.least = np.array(least, np.int32)
        self.where = np.zeros(self.n, np.int64)
        self.where[self.order] = np.arange(self.n)

    def _ranges(self) -> tuple[list[int], list[int]]:
        """Each node's children as a stretch of all children in reverse."""
        total = len(self.children)
        return (total - self.begin[1:]).tolist(), (total - self.begin[:-1]).tolist()

    def opposite(self) -> np.ndarray:
        """Suffixes in the order that compares symbols the other way round, the end mark still least."""
        # Children from the last to the first, but for the end mark, which goes first again.
        rank = np.where(self.symbols == 0, self.symbols.max(), self.symbols - 1)
        kids = self.children[np.lexsort((rank, self.parents))].tolist()
        lo, hi, leaves, path = self.begin[:-1].tolist(), self.begin[1:].tolist(), [], [0]
        while path:
            node = path.pop()
            if lo[node] == hi[node]:
                leaves.append(node)
            else:
                path += kids[lo[node] : hi[node]]
        return self.suffix[leaves]

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes; one of length 0 is at ``n - 1``."""
        a, b = self.where[left], self.where[right]
        # The least depth met from the leaf of the one to the leaf of the other.
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(hi - lo + 1)[1] - 1
        out = np.zeros(len(left), np.int64)
        least = self.least
        # One level of the sparse table at a time is held: all questions are known beforehand.
        for k in range(int(level.max(initial=-1)) + 1):
            mine = np.flatnonzero(level == k)
            out[mine] = np.minimum(least[lo[mine]], least[hi[mine] - (1 << k) + 1])
            if len(least) > 1 << k:
                least = np.minimum(least[: len(least) - (1 << k)], least[1 << k :])
        return out


def _next_less(rank: list[int]) -> list[int]:
    """For each place the next one of lower rank, or the end."""
    n = len(rank)
    out, waiting = [n] * n, []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return out


def runs_of(values: list[int], min_length: int = MIN_LENGTH) -> Runs:
    """``start, length, period`` of all runs of numbers, in that order."""
    n = len(values)
    if n < 2:
        return []
    forward, backward = SuffixTree(values), SuffixTree(values[::-1])
    starts, ends = [], []
    for order in (forward.order, forward.opposite()):
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.arange(n)
        starts.append(np.arange(n))
        ends.append(np.array(_next_less(rank.tolist())))
    start, end = np.concatenate(starts), np.concatenate(ends)
    period = end - start
    # Ahead from the root's start and end; back from the words before them.
    ahead = forward.common(start, end)
    back = backward.common(n - start, n - end)
    length = back + period + ahead
    keep = length >= np.maximum(min_length, 2 * period)
    found = np.unique(np.stack([start[keep] - back[keep], period[keep], length[keep]], axis=1), axis=0)
    return [(int(s), int(m), int(q)) for s, q, m in found]


def _numbered(words: list[bytes]) -> list[int]:
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return list(map(numbers.__getitem__, words))


def stretches(numbers: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Where windows that stand in the text more than once cover it, as begin and end."""
    n = len(numbers) - window + 1
    if n < 2:
        return []
    # Equal windows have equal sums; unequal ones with equal sums only make a stretch longer.
    sums = np.zeros(n, np.uint64)
    for k in range(window):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + n].astype(np.uint64)
        sums ^= sums >> np.uint64(29)
    order = np.argsort(sums)
    same = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
    if not len(same):
        return []
    change = np.zeros(len(numbers) + 1, np.int32)
    again = np.zeros(n, bool)
    again[order[same]] = again[order[same + 1]] = True
    change[:n] += again
    change[window : window + n] -= again
    inside = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    edge = np.diff(inside)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def text_runs(words: list[bytes], min_length: int = MIN_LENGTH) -> Runs:
    """All runs of words with ``min_length`` words and two periods at least, in order."""
    if len(words) < min_length:
        return []
    numbers = np.array(_numbered(words))
    window = max(1, min_length // 2)
    found: Runs = []
    waiting = [(0, len(words))]
    while waiting:
        begin, end = waiting.pop()
        for b, e in stretches(numbers[begin:end], window):
            if e - b < min_length:
                continue
            if e - b < end - begin:
                # Windows that stood again elsewhere only need not do so in here.
                waiting.append((begin + b, begin + e))
                continue
            inner = np.unique(numbers[begin:end], return_inverse=True)[1].tolist()
            found += [(s + begin, m, q) for s, m, q in runs_of(inner, min_length)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: Runs) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id, runs, collapsed``: every text's runs, and its words without repetitions.

    ``runs`` are structs of ``start, length, period`` by start, then period. Words are what stands
    between ASCII white space; kept ones are joined by one space. ``rewrite`` changes a row's words
    first. NULL and empty texts, and those of few words, have no runs. NULL and repeated doc_ids
    are kept, row by row; other columns are dropped; an empty table gives none. A text of any
    length is worked on whole, in time and memory that grow with it.
    """
    rows = spread(docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in bounded(batch)):
            runs, texts = [], []
            for name, value in zip(part.column("doc_id").to_pylist(), part.column("text")):
                words = (value.as_buffer().to_pybytes() if value.is_valid else b"").split()
                if rewrite:
                    words = rewrite(name, words)
                found = text_runs(words, min_length)
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                texts.append(b" ".join(collapsed(words, found)).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(runs, types), pa.array(texts, pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: a tenth of the documents repeat some of their words to the end."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, root = words[:a], words[a : a + p]
    return head + (root * ((n - a) // len(root) + 1))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest, and digests of all and of the words kept."""
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    # Longest first, then the smallest start, then period: the least of these structs.
    order = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_best.start").alias("start"),
        (-F.col("_best.less")).alias("length"), F.col("_best.period").alias("period"),
        F.floor(F.expr("1000 * -_best.less div _best.period")).alias("exponent_milli"),
        F.sha2(F.encode(text, "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLE: dict[str, str] = {}
