"""Line dedup by a suffix array over line-ID sequences.

The corpus is one sequence of line ids, documents in ``doc_id`` order, cut between
documents. Blank lines are no part of it. Prefix doubling gives every place the rank of
the run of 1, 2, 4, .. lines that starts there: places of equal rank start equal runs, so a
rank is an interval of the suffix array with a common prefix of that length. A rank is
named by the first place that has it. Places whose run occurs nowhere else drop out at
each step, which leaves the repeated text only.

A run is worth deleting from ``min_words`` words on. Looked at are the shortest such run that
starts at each place and the shortest that ends there; they have a known number of lines, m, and
their interval follows from the ranks of the two overlapping power-of-two runs that cover
them, so doubling stops at m, which is ``min_words`` at most. Every run of an interval but the
first is a later copy. Every line of a maximal repeated run lies in one of its shortest runs,
by its start or by its end, so the union of their later copies is that of the maximal runs'.

Everything is SQL. Ranks are found by aggregation before a join, so a line that fills a third
of the corpus is one row per task and rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import table, text_or_empty
from mailweir.session import stage

MIN_WORDS = 20
_NO_ID = -(1 << 63)
_BLANK = r"^[\x20\x09-\x0D]*$"


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("d"), F.xxhash64(body).alias("h"), body.alias("body")
    )


def _place() -> Column:
    return F.struct("d", "h", "seq")


def line_places(keyed: DataFrame) -> DataFrame:
    """``d, h, line, seq, a, b, words``: every line that is not blank; ``seq`` counts them
    in their document, ``a`` and ``b`` identify the line."""
    lines = F.transform(
        F.split("body", "\n"),
        lambda x, i: F.struct(
            i.alias("line"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
            F.when(F.rlike(x, F.lit(_BLANK)), F.lit(0)).otherwise(
                F.size(F.array_remove(F.split(F.translate(x, "\t\x0b\x0c\r", "    "), " "), ""))
            ).alias("words"),
        ),
    )
    full = F.filter(lines, lambda x: x["words"] > 0)
    # Rows of the same id and text are one document.
    once = keyed.select("d", "h", full.alias("full"))
    return once.select("d", "h", F.posexplode("full").alias("seq", "one")).select(
        "d", "h", "one.line", "seq", "one.a", "one.b", "one.words"
    )


def _named(places: DataFrame, *keys: str) -> DataFrame:
    """Keep places whose keys occur at more than one place, ranked by the first of them."""
    ranks = places.groupBy(*keys).agg(F.min(_place()).alias("rank"), F.max(_place()).alias("_last"))
    # Written first, so that the places of a frequent line can be split over tasks.
    return places.join(stage(ranks.filter("rank < _last").drop("_last"), "runs-ranks"), list(keys))


def _later() -> Column:
    return _place() > F.col("rank")


def shortest_runs(places: DataFrame, min_words: int) -> DataFrame:
    """``d, h, seq, m``: for each line the shortest runs of ``min_words`` words that start or end there."""
    document = Window.partitionBy("d", "h")
    start = F.sum("words").over(document.orderBy("seq")) - F.col("words")
    # From a line on: the lines that start before its words are complete; and the mirror image.
    after = document.orderBy("start").rangeBetween(0, min_words - 1)
    before = document.orderBy("end").rangeBetween(1 - min_words, 0)
    sized = (
        places.withColumn("start", start)
        .withColumn("end", F.col("start") + F.col("words"))
        .select(
            "d", "h", "seq",
            F.when(F.max("end").over(after) - F.col("start") >= min_words, F.count(F.lit(1)).over(after)).alias("on"),
            F.when(F.col("end") - F.min("start").over(before) >= min_words, F.count(F.lit(1)).over(before)).alias("back"),
        )
    )
    forward = F.struct(F.col("seq").alias("seq"), F.col("on").alias("m"))
    backward = F.struct((F.col("seq") - F.col("back") + 1).cast("int").alias("seq"), F.col("back").alias("m"))
    return sized.select("d", "h", F.inline(F.array(forward, backward))).filter("m is not null").distinct()


def later_copies(places: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs ``d, h, seq, m`` of ``m`` lines that stand earlier in the corpus as well."""
    runs = stage(_named(places, "a", "b").select("d", "h", "seq", "rank"), "runs-1")
    wanted = shortest_runs(places, min_words).join(runs.select("d", "h", "seq"), ["d", "h", "seq"], "left_semi")
    wanted = stage(wanted, "runs-wanted")
    copies = []
    length = 1
    while True:
        # Runs of `length` to `2 * length - 1` lines are covered by two of `length`.
        here = wanted.filter((F.col("m") >= length) & (F.col("m") < 2 * length)).join(runs, ["d", "h", "seq"])
        if length > 1:
            tails = runs.select("d", "h", F.col("seq").alias("tail"), F.col("rank").alias("rank_tail"))
            covered = here.withColumn("tail", F.col("seq") + F.col("m") - length).join(tails, ["d", "h", "tail"])
            here = _named(
                covered.select("d", "h", "seq", "m", F.col("rank").alias("rank_head"), "rank_tail"),
                "m", "rank_head", "rank_tail",
            )
        copies.append(here.filter(_later()).select("d", "h", "seq", "m"))
        if 2 * length > min_words:
            break
        # The rank of the run that follows, if its place is still there.
        ahead = Window.partitionBy("d", "h").orderBy("seq").rangeBetween(length, length)
        pairs = runs.select(
            "d", "h", "seq", F.col("rank").alias("rank_one"), F.max("rank").over(ahead).alias("rank_next")
        ).filter("rank_next is not null")
        length *= 2
        runs = stage(_named(pairs, "rank_one", "rank_next").select("d", "h", "seq", "rank"), f"runs-{length}")
    found = copies[0]
    for more in copies[1:]:
        found = found.unionByName(more)
    return found


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Texts without their later copies of repeated runs of lines.

    One row per input row: ``doc_id, n_lines, n_removed, n_runs, text``. Of equal runs the first in the
    order of ``doc_id`` (NULL first, then by a hash of the text), then of lines, stays. Blank
    lines neither make nor break a run and are never removed. Lines are compared as they
    stand, byte by byte. A NULL text is empty; rows equal in id and text are one document and get the
    same result; an empty table gives no rows. Other columns are not looked at.
    """
    keyed = _keyed(docs, doc_id, text)
    places = stage(line_places(keyed).dropDuplicates(["d", "h", "seq"]), "runs-lines")
    copies = stage(later_copies(places, min_words), "runs-copies")
    gone = (
        copies.select("d", "h", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("m") - 1)).alias("seq")).distinct()
    )
    lines = gone.join(places.select("d", "h", "seq", "line"), ["d", "h", "seq"])
    before = Window.partitionBy("d", "h").orderBy("seq")
    opens = F.coalesce(F.col("seq") - F.lag("seq").over(before), F.lit(2)) > 1
    removed = (
        lines.withColumn("opens", opens)
        .groupBy("d", "h")
        .agg(
            F.sort_array(F.collect_list("line")).alias("gone"),
            F.count(F.lit(1)).alias("n_removed"), F.sum(F.col("opens").cast("bigint")).alias("n_runs"),
        )
    )
    lines_of = F.split("body", "\n")
    # What lies between one removed line and the next, in slices.
    between = F.zip_with(
        F.concat(F.array(F.lit(-1)), F.col("gone")), F.concat(F.col("gone"), F.array(F.size("body_lines"))),
        lambda one, other: F.slice("body_lines", one + 2, other - one - 1),
    )
    return keyed.join(removed, ["d", "h"], "left").withColumn("body_lines", lines_of).select(
        F.nullif("d", F.lit(_NO_ID)).alias("doc_id"),
        F.size("body_lines").cast("bigint").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_runs", F.lit(0)).alias("n_runs"),
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(F.flatten(between), "\n")).alias("text"),
    )


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


QUERIES = {"op10_line_runs": op10_line_runs}
ORACLE: dict[str, str] = {}
