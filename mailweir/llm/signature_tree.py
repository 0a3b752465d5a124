"""Exact n-gram Jaccard join with signature trees.

A document is the set of its word shingles. Documents of equal sets are one class.

*Which trees a class is in.* With shingles in one common order, rare ones first, two sets that
are similar enough share one among their first few (for n shingles and a Jaccard limit
t, the first ``n - ceil(t n) + 1``). Every shingle that is among the first of several classes
is the root of a tree, and a class is in the trees of its first shingles. The order comes from a
table of 2^18 counters, filled by all documents, so that what many documents share is
nobody's first shingle. Any order gives the same result. Trees whose least class is the
same are one tree, so near copies, which share most of their first shingles, meet in few.

*A tree.* Leaves hold classes next in size, with a bitmap of each set; a node holds the OR
of its bitmaps and its range of sizes. Two nodes are visited together and dropped if
their sizes are too far apart, if neither has a class whose greatest possible overlap with the
other's bitmap is enough, or if all their classes are one component already. A first walk
with bitmaps of 1024 bits keeps the classes that have a candidate at all; most, which only share
a shingle by chance, end there. The others are walked with 4096 bits.

*Groups of copies.* That walk takes its candidates for links as it goes, skips nodes that are joined
by them, and hands over one candidate per join: no more than there are classes. They are
compared word by word, and the links among them make components. A last walk over the trees that
skipped anything hands over every candidate between different components, which are compared
as well. In a large group of near copies that is next to nothing. A tree with very many classes is
walked by several tasks, each a pair of its parts.

The result is exact: no bucket, tree or candidate is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import spaced_words, table, text_or_empty
from mailweir.llm.components import components
from mailweir.session import stage

#: Counters of the table that orders shingles: a 1 MB array.
COUNTERS = 1 << 18
#: 64-bit words of the two bitmaps; the coarse one joins neighbouring bits of the fine one.
FINE_WORDS, COARSE_WORDS = 64, 16
LEAF, FAN = 32, 8
#: Classes of a tree that one task walks; a larger tree is walked in parts.
PART = 4096
#: Rows of a task that walks trees.
TASK_ROWS = 40_000
#: Bits of the filter that keeps texts out of the shuffle which no pair asks for.
FILTER_BITS = 1 << 23
CACHE_WORDS = 300_000
_NO_ID = (1 << 63) - 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], size: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``size`` are one."""
    if not words:
        return np.empty(0, np.uint64)
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(numbers) - size + 1
    mixed = np.full(n, size, np.uint64)
    for j in range(size):
        mixed = (mixed ^ numbers[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def shingle_set(words: list[bytes], size: int) -> set:
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


def _slots(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(COUNTERS - 1)).astype(np.int64)


def shingle_counts(docs: DataFrame, size: int) -> np.ndarray:
    """For each counter the documents whose shingles fall to it: ``COUNTERS`` numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _Hashes(), np.zeros(COUNTERS, np.int64)
        held, many = [], 0
        for batch in batches:
            for value in batch.column("text"):
                held.append(shingle_hashes(spaced_words(value.as_py()), size, hashes))
                many += len(held[-1])
                if many > 4 * COUNTERS:
                    counts += np.bincount(_slots(np.concatenate(held)), minlength=COUNTERS)
                    held, many = [], 0
        if held:
            counts += np.bincount(_slots(np.concatenate(held)), minlength=COUNTERS)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], names=["slot", "n"])

    rows = docs.select("text").mapInArrow(count, "slot bigint, n bigint")
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return np.minimum(counts, (1 << 32) - 1).astype(np.uint32)


def _profile(docs: DataFrame, size: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """``d, h, n, digest, first, coarse, fine`` of every document: set size, digest of the set,
    its first shingles, its bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sizes, digests, firsts, coarse, fine = [], [], [], [], []
            for value in batch.column("text"):
                found = shingle_hashes(spaced_words(value.as_py()), size, hashes)
                n = len(found)
                sizes.append(n)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) + n.to_bytes(8, "little"))
                keep = n - -(-num * n // den) + 1 if n else 0
                order = np.lexsort((found, counts[_slots(found)]))[:keep]
                firsts.append(found[order].view(np.int64))
                bitmap = np.zeros(FINE_WORDS * 64, np.uint8)
                bitmap[(found >> np.uint64(52)).astype(np.int64)] = 1
                fine.append(np.packbits(bitmap).tobytes())
                coarse.append(np.packbits(bitmap.reshape(COARSE_WORDS * 64, -1).max(axis=1)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d"), batch.column("h"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(firsts, pa.list_(pa.int64())), pa.array(coarse, pa.binary()), pa.array(fine, pa.binary()),
                ],
                names=["d", "h", "n", "digest", "first", "coarse", "fine"],
            )

    return docs.select("d", "h", "text").mapInArrow(
        run, "d bigint, h bigint, n bigint, digest binary, first array<bigint>, coarse binary, fine binary"
    )


class _Node:
    __slots__ = ("rows", "bits", "small", "large", "comps", "children")

    def __init__(self, rows, bits, small, large, comps, children):
        self.rows, self.bits, self.small, self.large = rows, bits, small, large
        self.comps, self.children = comps, children


class SignatureTree:
    """Classes of one tree, by component and size, under nodes of OR-combined bitmaps."""

    def __init__(self, sizes: np.ndarray, comps: np.ndarray, bits: np.ndarray, num: int, den: int):
        self.sizes, self.comps, self.bits, self.num, self.den = sizes, comps, bits, num, den
        order = np.lexsort((sizes, comps))
        level = []
        for at in range(0, len(order), LEAF):
            rows = order[at : at + LEAF]
            level.append(_Node(
                rows, np.bitwise_or.reduce(bits[rows], axis=0), sizes[rows].min(), sizes[rows].max(),
                (comps[rows].min(), comps[rows].max()), None,
            ))
        while len(level) > 1:
            level = [self._above(level[at : at + FAN]) for at in range(0, len(level), FAN)]
        self.root = level[0]
        #: What a walk takes for joined, if it does; whether that made it skip anything.
        self.joined: np.ndarray | None = None
        self.skipped = False

    @staticmethod
    def _above(nodes: list[_Node]) -> _Node:
        return _Node(
            np.concatenate([n.rows for n in nodes]), np.bitwise_or.reduce([n.bits for n in nodes], axis=0),
            min(n.small for n in nodes), max(n.large for n in nodes),
            (min(n.comps[0] for n in nodes), max(n.comps[1] for n in nodes)), nodes,
        )

    def _hopeful(self, rows: np.ndarray, other: _Node) -> np.ndarray:
        """Rows whose greatest overlap with any class of the node could be enough."""
        sizes = self.sizes[rows]
        missing = np.bitwise_count(self.bits[rows] & ~other.bits).sum(axis=1)
        partner = np.maximum(other.small, -(-self.num * sizes // self.den))
        return rows[(self.num + self.den) * (sizes - missing) >= self.num * (sizes + partner)]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of two classes each that may be similar, of different components."""
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            if a.comps[0] == a.comps[1] == b.comps[0] == b.comps[1]:
                continue
            if self.num * a.small > self.den * b.large or self.num * b.small > self.den * a.large:
                continue
            if self.joined is not None:
                labels = self.joined[a.rows]
                if (labels == labels[0]).all() and (self.joined[b.rows] == labels[0]).all():
                    self.skipped |= len(a.rows) > 1 or a is not b
                    continue
            if a.children is None and b.children is None:
                found = self._compare(a, b)
                if len(found[0]):
                    yield found
                continue
            if a is not b and not (len(self._hopeful(a.rows, b)) and len(self._hopeful(b.rows, a))):
                continue
            if a is b:
                todo += [(x, y) for k, x in enumerate(a.children) for y in a.children[k:]]
            elif b.children is None or a.children is not None and len(a.rows) >= len(b.rows):
                todo += [(x, b) for x in a.children]
            else:
                todo += [(a, y) for y in b.children]

    def _compare(self, a: _Node, b: _Node) -> tuple[np.ndarray, np.ndarray]:
        left, right = self._hopeful(a.rows, b), self._hopeful(b.rows, a)
        if not len(left) or not len(right):
            return left[:0], right[:0]
        x, y = self.bits[left][:, None, :], self.bits[right][None, :, :]
        nx, ny = self.sizes[left][:, None], self.sizes[right][None, :]
        most = np.minimum(
            nx - np.bitwise_count(x & ~y).sum(axis=2), ny - np.bitwise_count(y & ~x).sum(axis=2)
        )
        good = (self.num + self.den) * most >= self.num * (nx + ny)
        good &= self.comps[left][:, None] != self.comps[right][None, :]
        if a is b:
            good &= left[:, None] < right[None, :]
        i, j = np.nonzero(good)
        return left[i], right[j]


    def forest(self, ours) -> list[tuple[int, int]]:
        """One candidate for each join that all candidates would make."""
        self.joined = np.arange(len(self.sizes))
        taken = []
        for i, j in self.pairs():
            mine = ours(i, j)
            i, j = i[mine], j[mine]
            fresh = self.joined[i] != self.joined[j]
            self.skipped |= not fresh.all()
            for x, y in zip(i[fresh].tolist(), j[fresh].tolist()):
                one, other = self.joined[x], self.joined[y]
                if one == other:
                    self.skipped = True
                    continue
                self.joined[self.joined == other] = one
                taken.append((x, y))
        return taken


_ROW = "tree bigint, p int, q int, cid bigint, n bigint, comp bigint, here boolean, there boolean"
_PAIR = "a bigint, b bigint, tree bigint, p int, q int, more boolean"


def _walk(num: int, den: int, words: int, kind: str):
    """Walk the trees, or parts of one, that a task holds.

    ``rows`` returns the rows that have a candidate, ``forest`` one candidate per join with a
    mark if the tree has more, ``all`` every candidate.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tree", "p", "q", "cid"], kind="stable").reset_index(drop=True)
        keys = rows[["tree", "p", "q"]].to_numpy()
        edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        cids, sizes, comps = (rows[c].to_numpy(np.int64) for c in ("cid", "n", "comp"))
        bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(len(rows), words)
        here, there = rows["here"].to_numpy(bool), rows["there"].to_numpy(bool)
        busy = np.zeros(len(rows), bool)
        pairs: list[tuple[int, int, int, bool]] = []
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)]):
            if hi - lo < 2:
                continue
            at = slice(lo, hi)
            first, second = here[at], there[at]
            tree = SignatureTree(sizes[at], comps[at], bits[at], num, den)

            def ours(i, j, first=first, second=second):
                return first[i] & second[j] | first[j] & second[i]

            if kind == "forest":
                taken = tree.forest(ours)
                pairs += [(lo + i, lo + j, lo, tree.skipped) for i, j in taken]
                continue
            for i, j in tree.pairs():
                mine = ours(i, j)
                i, j = i[mine] + lo, j[mine] + lo
                busy[i] = busy[j] = True
                if kind == "all":
                    pairs += [(x, y, lo, False) for x, y in zip(i.tolist(), j.tolist())]
        if kind == "rows":
            return rows[busy].drop(columns=["bits", "task"])
        i, j, at = (np.array([x[k] for x in pairs], np.int64) for k in range(3))
        found = pd.DataFrame({"a": np.minimum(cids[i], cids[j]), "b": np.maximum(cids[i], cids[j])})
        for c in ("tree", "p", "q"):
            found[c] = rows[c].to_numpy()[at]
        found["more"] = np.array([x[3] for x in pairs], bool)
        return found

    return run


def _filter_of(ids: DataFrame) -> bytes:
    """Which hashes of ``d, h`` occur, as a bitmap of fixed size (256 rows of 4 KB)."""
    slot = F.pmod(F.xxhash64("d", "h"), F.lit(FILTER_BITS)) + 1
    rows = (
        ids.select(F.bitmap_bucket_number(slot).alias("k"), F.bitmap_bit_position(slot).alias("p"))
        .groupBy("k").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    )
    whole = bytearray(FILTER_BITS // 8)
    for row in rows:
        whole[(row["k"] - 1) * 4096 : row["k"] * 4096] = row["bits"]
    return bytes(whole)


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, text`` of the classes asked for. Texts that the filter rules out are not shuffled."""
    ids = stage(wanted.join(classes.select("cid", "d", "h"), "cid"), "tree-wanted")
    bits = _filter_of(ids)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            yield batch.filter(pa.array((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))

    slotted = docs.select("d", "h", F.pmod(F.xxhash64("d", "h"), F.lit(FILTER_BITS)).alias("slot"), "text")
    near = slotted.mapInArrow(keep, "d bigint, h bigint, slot bigint, text string")
    texts = near.join(ids, ["d", "h"]).select("cid", "text")
    return stage(texts.dropDuplicates(["cid"]), "tree-texts")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs that are similar, found by comparing the shingles themselves."""
    pairs = stage(pairs, "tree-pairs")
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    texts = _texts(docs, classes, wanted)
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, set()
        for batch in batches:
            kept = []
            hubs, texts_a, texts_b = batch.column("b").to_pylist(), batch.column("text_a"), batch.column("text_b")
            for k, hub in enumerate(hubs):
                if hub != last:  # rows come sorted by b
                    last, other = hub, shingle_set(spaced_words(texts_b[k].as_py()), size)
                one = shingle_set(spaced_words(texts_a[k].as_py()), size)
                shared = len(one & other)
                kept.append(den * shared >= num * (len(one) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _walked(rows: DataFrame, bitmaps: DataFrame, num: int, den: int, words: int, kind: str) -> DataFrame:
    """All trees of ``rows``, each walked in one task with the bitmaps of its classes."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, rows.count() // TASK_ROWS)
    with_bits = rows.join(bitmaps.toDF("cid", "bits"), "cid").withColumn(
        "task", F.pmod(F.xxhash64("tree", "p", "q"), F.lit(tasks))
    )
    schema = _ROW if kind == "rows" else _PAIR
    columns = [c.split()[0] for c in _ROW.split(", ")]
    return with_bits.select(*columns, "bits", "task").groupBy("task").applyInPandas(_walk(num, den, words, kind), schema)


def _tree_rows(alive: DataFrame) -> DataFrame:
    """Classes of each tree, with large trees cut into pairs of parts."""
    rows = alive.withColumnRenamed("lo", "tree")
    parts = rows.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).filter("parts > 1")
    # Written first, so that the join's large side can be split by itself.
    sized = rows.join(stage(parts, "tree-parts"), "tree", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = sized.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    return cut.select(
        "tree", F.least("own", "with").alias("p"), F.greatest("own", "with").alias("q"), "cid", "n",
        F.col("cid").alias("comp"), (F.col("own") <= F.col("with")).alias("here"), (F.col("own") >= F.col("with")).alias("there"),
    )


def _links(alive: DataFrame, profile: DataFrame, classes: DataFrame, keyed: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``node, root`` of all classes that link with another."""
    def bitmaps(name: str, rows: DataFrame) -> DataFrame:
        wanted = classes.join(rows.select("cid").distinct(), "cid").select("cid", "d", "h")
        # Rows of the same id and text have the same bitmap.
        return profile.select("d", "h", name).join(wanted, ["d", "h"]).select("cid", name).dropDuplicates(["cid"])

    trees = stage(_tree_rows(alive), "tree-rows")
    busy = stage(_walked(trees, bitmaps("coarse", trees), num, den, COARSE_WORDS, "rows"), "tree-busy")
    fine = stage(bitmaps("fine", busy), "tree-fine")
    forest = stage(_walked(busy, fine, num, den, FINE_WORDS, "forest"), "tree-forest")
    links = stage(_verified(forest.select("a", "b").distinct(), keyed, classes, words, num, den), "tree-links")
    comps = stage(components(links.toDF("u", "v")), "tree-comps")
    open_trees = forest.filter("more").select("tree", "p", "q").distinct()
    rest = busy.join(open_trees, ["tree", "p", "q"]).drop("comp").join(comps.toDF("cid", "root"), "cid", "left")
    rest = rest.withColumn("comp", F.coalesce("root", "cid"))
    columns = [c.split()[0] for c in _ROW.split(", ")]
    rest = stage(rest.select(*columns), "tree-rest")
    more = _walked(rest, fine, num, den, FINE_WORDS, "all").select("a", "b").distinct()
    more = more.join(forest.select("a", "b").distinct(), ["a", "b"], "left_anti")
    more = stage(_verified(more, keyed, classes, words, num, den), "tree-more")
    return components(links.union(more).toDF("u", "v"))


def _groups(docs: DataFrame, words: int, num: int, den: int, doc_id: str, text: str) -> DataFrame:
    """``d, h, n, rep`` of every row: its key, set size, and the least key that links reach (NULL without words)."""
    body = text_or_empty(text)
    keyed = docs.select(*_key(doc_id, text), body.alias("text"))
    counts = shingle_counts(keyed, words)
    profile = stage(_profile(keyed, words, num, den, counts), "tree-profile")
    classes = profile.filter("n > 0").groupBy("digest").agg(F.min(F.struct("d", "h")).alias("rep"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("cid"), "digest", "rep.d", "rep.h"), "tree-classes")
    own = profile.select("d", "h", "n", "first").join(classes.select("cid", "d", "h"), ["d", "h"])
    places = own.select("cid", "n", F.explode("first").alias("token"))
    shared = places.groupBy("token").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).filter("lo < hi")
    alive = places.join(shared.select("token", "lo"), "token").select("cid", "n", "lo").distinct()
    comps = _links(stage(alive, "tree-alive"), profile, classes, keyed, words, num, den)
    named = classes.join(comps.toDF("cid", "root"), "cid", "left").select(
        F.coalesce("root", "cid").alias("root"), "digest", F.struct("d", "h").alias("rep")
    )
    least = named.groupBy("root").agg(F.min("rep").alias("rep"))
    reps = named.select("root", "digest").join(least, "root").select("digest", "rep")
    return profile.select("d", "h", "n", "digest").join(reps, "digest", "left").drop("digest")


def _key(doc_id: str, text: str) -> list[Column]:
    """A document's id, NULL as the largest, and a hash of its text."""
    return [
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("d"), F.xxhash64(text_or_empty(text)).alias("h")
    ]


def similar(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two documents link if ``den * shared >= num * union`` of their sets of ``words``-word
    shingles. The component is the smallest ``doc_id`` that links reach. A text of fewer words is one
    shingle; an empty or NULL text has none and links with nothing. NULL ids come after all
    others and stay NULL; repeated rows are equal sets and link; an empty table gives no
    rows. Other columns are not looked at.
    """
    component = F.nullif(F.coalesce("rep.d", "d"), F.lit(_NO_ID))
    return _groups(docs, words, num, den, doc_id, text).select(
        F.nullif("d", F.lit(_NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: the one of the
    least id. Documents without words all stay; of rows equal in id and text one stays."""
    groups = _groups(docs, words, num, den, doc_id, text)
    kept = groups.filter("rep is null or (rep.d = d and rep.h = h)").select("d", "h").distinct()
    names = docs.columns
    rows = docs.select(*_key(doc_id, text), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    turn = F.row_number().over(Window.partitionBy("d", "h").orderBy(F.lit(0)))
    return rows.join(kept, ["d", "h"], "left_semi").withColumn("turn", turn).filter("turn = 1").select("row.*")


def op3_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


# Shingles as text; candidates share at least one, and every pair is counted in full.
ORACLE: dict[str, str] = {
    "op3_signature_tree": """
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM doc WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM place),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM doc UNION SELECT reach.x, way.y FROM reach JOIN way ON reach.y = way.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
FROM doc JOIN reach ON doc_id = x LEFT JOIN size USING (doc_id) GROUP BY doc_id
""",
}
QUERIES = {"op3_signature_tree": op3_signature_tree}
