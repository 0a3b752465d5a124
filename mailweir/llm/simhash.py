"""Document fingerprints by SimHash.

The terms of a text are its runs of three words. Each term's hash votes for or against
each of 64 bits with the term's weight, its length up to 31 bytes, once for every time it
occurs; a bit is set if more than half of the weight votes for it.

All of it is SQL. Votes are counted three bits to a long, in lanes of 21 bits: a sum over
a stretch of 65,536 terms stays below 2^21 in every lane, and stretches are added up after
unpacking, so no length of text overflows.

Near fingerprints are found with block tables: the 64 bits are cut into blocks, and each
stored fingerprint is keyed by each of its blocks. Each block has a radius of its own, chosen
so that two fingerprints within the whole radius are within it in one block at least; a query
asks for every value of a block within that radius. Nothing within the radius is missed.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from mailweir.llm.common import table, text_or_empty
from mailweir.operators.order import with_position
from mailweir.session import stage

#: Words of a term.
TERM_WORDS = 3
_WEIGHT = 31
_STRETCH = 1 << 16
_LANE = (1 << 21) - 1
_LANES = 1 | 1 << 21 | 1 << 42
_NO_ID = -(1 << 63)
#: Bits that near copies may differ in, from recall against brute force at Jaccard 0.8 (README).
NEAR_BITS = 12


def _terms(text: str) -> Column:
    """Hash and, in the lowest five bits, weight of each run of three words.

    A text of fewer words is one run; one without words has none.
    """
    spaced = F.translate(text_or_empty(text), "\t\n\x0b\x0c\r", "     ")
    words = F.array_remove(F.split(spaced, " "), "")

    def term(words: Column, i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(TERM_WORDS)]
        length = sum((F.coalesce(F.octet_length(p), F.lit(0)) for p in parts[1:]), F.octet_length(parts[0]))
        weight = F.least(length, F.lit(_WEIGHT)).cast("bigint")
        return F.xxhash64(*parts).bitwiseAND(F.lit(~_WEIGHT)).bitwiseOR(weight)

    def all_terms(words: Column) -> Column:
        last = F.greatest(F.size(words) - TERM_WORDS, F.lit(0))
        return F.when(
            F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: term(words, i))
        )

    # Bound by a one-element list, or the words would be cut again at each mention.
    return F.get(F.transform(F.array(words), all_terms), F.lit(0))


def fingerprints(docs: DataFrame, keys: list[str], text: str, name: str = "fingerprint") -> DataFrame:
    """One row per key with the SimHash of its text as a long; no words give 0.

    Rows of equal keys count as one text.
    """
    terms = docs.select(*keys, F.posexplode_outer(_terms(text)).alias("_i", "_term"))
    voted = terms.select(
        *keys,
        F.shiftright("_i", 16).alias("_stretch"),
        F.col("_term").bitwiseAND(F.lit(_WEIGHT)).alias("_weight"),
        F.xxhash64("_term").alias("_votes"),
    )
    lanes = [
        F.sum(F.col("_weight") * F.shiftrightunsigned("_votes", i).bitwiseAND(F.lit(_LANES))).alias(f"_s{i}")
        for i in range(21)
    ]
    sums = voted.groupBy(*keys, "_stretch").agg(
        *lanes, F.sum(F.col("_weight") * F.shiftrightunsigned("_votes", 63)).alias("_s63"),
        F.sum("_weight").alias("_all"),
    )
    # Bit i + 21 * lane, for the three lanes of each sum, and the last bit.
    counts = {
        i + 21 * lane: F.sum(F.shiftrightunsigned(f"_s{i}", 21 * lane).bitwiseAND(F.lit(_LANE)))
        for i in range(21) for lane in range(3)
    }
    counts[63] = F.sum("_s63")
    total = sums.groupBy(*keys).agg(
        *[c.alias(f"_b{bit}") for bit, c in counts.items()], F.sum("_all").alias("_all")
    )
    print_ = F.lit(0).cast("bigint")
    for bit in range(64):
        value = (1 << bit) - (1 << 64 if bit == 63 else 0)
        print_ = print_.bitwiseOR(
            F.when(F.col(f"_b{bit}") * 2 > F.col("_all"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        )
    return total.select(*keys, print_.alias(name))


def as_text(fingerprint: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: str | Column, b: str | Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - distance(a, b) / F.lit(64.0)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def block_radii(radius: int, blocks: int) -> list[tuple[int, int, int]]:
    """(first bit, bit after the last, radius) of each block.

    The radii are such that one more bit in each block is more than ``radius``. A block of
    radius -1 need not be looked at.
    """
    if not 0 <= radius <= 64 or not 1 <= blocks <= 64:
        raise ValueError("a radius is up to 64 bits, and there are 1 to 64 blocks")
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    least, more = divmod(radius + 1, blocks)
    return [(edges[k], edges[k + 1], least + (k < more) - 1) for k in range(blocks)]


def _masks(radii: list[tuple[int, int, int]]) -> list[int]:
    return [_signed((1 << end) - (1 << start)) for start, end, _ in radii]


def _probes(fingerprint: str, radii: list[tuple[int, int, int]]) -> Column:
    """(block, value) for all values within the block's radius."""
    def asked(k: int, mask: int, flips: list[int]) -> Column:
        # One literal for the list, or each of its hundreds of values would be an expression.
        return F.transform(
            F.from_json(F.lit(str(flips)), "array<bigint>"),
            lambda flip: F.struct(
                F.lit(k).alias("_table"), F.col(fingerprint).bitwiseXOR(flip).bitwiseAND(F.lit(mask)).alias("_key")
            ),
        )

    flips = [
        [_signed(sum(1 << b for b in bits)) for n in range(most + 1) for bits in combinations(range(start, end), n)]
        for start, end, most in radii
    ]
    lists = [asked(k, mask, own) for k, (mask, own) in enumerate(zip(_masks(radii), flips)) if own]
    return F.inline(F.concat(*lists))


def near(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 4, name: str = "fingerprint") -> DataFrame:
    """All pairs of a query's and a stored fingerprint within ``radius`` bits.

    Both sides are reduced to distinct fingerprints first, so copies, however many, are
    one row; ``n`` counts the stored rows. A stored fingerprint has a row for each block, a query
    one for each value of a block to ask for. Result: ``query, found, bits, n``.
    """
    ask = queries.select(F.col(name).alias("query")).filter("query is not null").distinct()
    have = (
        prints.select(F.col(name).alias("found")).filter("found is not null")
        .groupBy("found").agg(F.count(F.lit(1)).alias("n"))
    )
    radii = block_radii(radius, blocks)
    looked = [(k, mask, most) for k, (mask, (_, _, most)) in enumerate(zip(_masks(radii), radii)) if most >= 0]
    a = ask.select("query", _probes("query", radii))
    keys = [F.struct(F.lit(k).alias("_table"), F.col("found").bitwiseAND(F.lit(mask)).alias("_key")) for k, mask, _ in looked]
    b = have.select("found", "n", F.inline(F.array(*keys)))
    bits = distance("query", "found")
    # A pair that meets in several blocks counts in the first.
    first = F.coalesce(*[
        F.when(F.bit_count(F.col("query").bitwiseXOR(F.col("found")).bitwiseAND(F.lit(mask))) <= most, F.lit(k))
        for k, mask, most in looked
    ])
    # Planned by the few queries they come from, the many values asked for would be broadcast.
    return (
        a.hint("merge").join(b, ["_table", "_key"])
        .filter((bits <= radius) & (F.col("_table") == first))
        .select("query", "found", bits.alias("bits"), "n")
    )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and of the next document.

    Documents are in ascending ``doc_id`` order, NULL first; where several rows share an id, in
    the order of a hash of their texts; rows equal in both are one document, and each gets its
    result. The edited text's last quarter is replaced by the first as many characters of
    the next document's (all, if it has fewer); after the last comes the first. Result:
    ``doc_id, n_chars, edited_sha256, print, edited, after``; an empty table gives no rows, and
    other columns are not looked at.
    """
    body = text_or_empty(text)
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("d"), F.xxhash64(body).alias("h"), body.alias("body")
    )
    rows = keyed.groupBy("d", "h").agg(F.max(F.length("body")).alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    order = with_position(rows, [F.col("d"), F.col("h")])
    order = stage(order.withColumn("position", F.col("position") - 1), "simhash-order")
    total = max(order.count(), 1)
    turn = order.select(
        F.col("d").alias("next_d"), F.col("h").alias("next_h"),
        F.pmod(F.col("position") - 1, F.lit(total)).alias("position"),
    )
    links = stage(order.join(turn, "position"), "simhash-links")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    asked = links.select(
        F.col("next_d").alias("d"), F.col("next_h").alias("h"), F.col("d").alias("of_d"), F.col("h").alias("of_h"),
        quarter.alias("wanted"),
    )
    facts = links.select("d", "h", "n_chars").join(asked, ["d", "h"])
    first = F.row_number().over(Window.partitionBy("d", "h").orderBy(F.lit(0)))
    texts = keyed.join(facts, ["d", "h"]).withColumn("_row", first).filter("_row = 1")
    heads = texts.select(
        F.col("of_d").alias("d"), F.col("of_h").alias("h"), F.left("body", F.col("wanted")).alias("head")
    )
    edited = texts.select("d", "h", "n_chars", "body").join(heads, ["d", "h"]).select(
        "d", "h", "body",
        F.concat(F.left("body", (F.col("n_chars") - quarter).cast("int")), F.col("head")).alias("edited"),
    )
    both = edited.select(
        "d", "h", F.sha2("edited", 256).alias("sha"),
        F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("body")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))),
    )
    prints = fingerprints(both, ["d", "h", "sha", "kind"], "body")
    prints = stage(
        prints.groupBy("d", "h", "sha").agg(
            F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("print"),
            F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited"),
        ),
        "simhash-prints",
    )
    nexts = prints.select(F.col("d").alias("next_d"), F.col("h").alias("next_h"), F.col("print").alias("after"))
    return (
        links.join(prints, ["d", "h"])
        .join(nexts, ["next_d", "next_h"])
        .select(
            F.nullif("d", F.lit(_NO_ID)).alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"),
            "print", "edited", "after", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"),
        )
        .drop("_copy")
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses; for ids divisible by 50 also how many other documents
    lie within ``NEAR_BITS``, and which.

    ``near_classes`` has a fingerprint, its distance and its number of documents for each
    distinct fingerprint found, the own one among them; the documents of a class are the rows with that
    ``fingerprint``.
    """
    found = stage(edited_fingerprints(table(spark, sf_dir, "documents")), "simhash-found")
    prints = found.select("doc_id", F.col("print").alias("fingerprint"))
    asked = prints.filter(F.col("doc_id") % 50 == 0)
    one = F.struct("bits", as_text("found").alias("fingerprint"), "n")
    counted = near(asked, prints, NEAR_BITS).groupBy(F.col("query").alias("print")).agg(
        (F.sum("n") - 1).alias("n_near"), F.array_sort(F.collect_list(one)).alias("near_classes")
    )
    counted = asked.select("doc_id", F.col("fingerprint").alias("print")).distinct().join(counted, "print")
    return found.join(counted, ["doc_id", "print"], "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text("print").alias("fingerprint"),
        as_text("edited").alias("edited_fingerprint"), likeness("print", "edited").alias("near_edited"),
        likeness("print", "after").alias("near_next"), "n_near", "near_classes",
    )


QUERIES = {"op6_simhash": op6_simhash}
ORACLE: dict[str, str] = {}
