"""URL filters with trust propagated over the link graph of hosts.

Rules decide first: the longest one that fits a page's host and path. The pages they
decide are the seeds. Trust flows from the hosts of allowed pages along the edges of the host
graph, as a PageRank whose restarts go to those hosts; distrust flows from the hosts of
blocked pages against the edges, as one links to bad hosts rather than bad hosts to one.
A page without a rule gets the verdict of its host: block if the host's distrust exceeds its
trust by more than a threshold, else allow.

Edges are links to other hosts in the pages' HTML, weighed by the number of pages that hold
them, and, both ways, the step from a host to the domain above it (``m.a.example`` to ``a.example``),
down to two labels: subdomains share an owner, and rules hold for them as well. The
second kind joins hosts whose pages only link to themselves.

Links are counted per pair of hosts before anything else, a page's repeated links once. Scores are one row
per host and kind and flow by joins on it; a hub's edges are summed on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.common import table, text_or_empty
from mailweir.session import ensure_checkpoint_dir, stage

# Fixed values: (verdict, host and path of the rule).
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
DAMPING = 0.85
#: Scores are settled once this little moves, summed over all hosts, from one checkpoint to the
#: next. What then still is to come is less than twice that, as damping shrinks it each round.
TOLERANCE = 1e-6
#: Rounds between checkpoints.
CUT = 4
#: Edges a task works on at least: small graphs make few tasks and files a round, however many
#: partitions the session's shuffles have.
TASK_EDGES = 250_000
#: A subdomain edge weighs as much as a link found on one page.
SITE_WEIGHT = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/"'?#\s>]+)"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    text = text_or_empty(url)
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    return (
        lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def rule_of(host: str, path: str, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``struct<size, rule, verdict>``, or NULL.

    For lists a person keeps: every rule is an expression.
    """
    fits = []
    for verdict, rule in rules:
        name, _, start = rule.partition("/")
        own = (F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))
        fit = own & F.startswith(F.col(path), F.lit("/" + start))
        fits.append(F.when(fit, F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
        )))
    return reduce(lambda a, b: F.greatest(a, b), fits[1:], fits[0]) if fits else F.lit(None).cast(
        "struct<size:int,rule:string,verdict:string>"
    )


def host_edges(judged: DataFrame) -> DataFrame:
    """Distinct edges ``src, dst, weight`` from pages with ``host`` and ``links``."""
    links = (
        judged.filter("host != ''")
        .select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .filter("src != dst and dst != ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    hosts = judged.select("host").union(judged.select(F.explode("links"))).distinct().filter("host != ''")
    labels = F.split("host", r"\.")
    above = (
        hosts.select(
            F.explode(
                F.when(
                    F.size(labels) > 2,
                    F.transform(
                        F.sequence(F.lit(1), F.size(labels) - 2),
                        lambda k: F.struct(
                            F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("src"),
                            F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("dst"),
                        ),
                    ),
                )
            ).alias("step")
        )
        .select("step.*")
        .distinct()
    )
    weight = F.lit(SITE_WEIGHT).alias("weight")
    both = above.select("src", "dst", weight).union(above.select(F.col("dst"), F.col("src"), weight))
    return links.unionByName(both.toDF("src", "dst", "weight")).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
    rounds: int | None = None,
) -> DataFrame:
    """Trust along the edges and distrust against them: ``host, trust, distrust``.

    ``seeds`` has ``host, kind, weight`` with kind ``trust`` or ``distrust``. Each kind's
    restarts sum to one. What reaches a host without an edge onward ends there. Rounds go on
    until the scores are settled; each shrinks what is left by the damping at least, so their
    number follows from it and the tolerance, and a host is reached from as many edges away.
    ``rounds`` asks for a fixed number instead.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    along = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    against = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ways = along.unionByName(against)
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    ways = stage(
        ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all") * damping).alias("part")),
        "trust-ways",
    )
    totals = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))  # two rows
    start = stage(
        seeds.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("score")),
        "trust-seeds",
    )
    restart = start.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
    tasks = max(1, -(-ways.count() // TASK_EDGES))
    scores, turn = start, 0
    while turn != rounds:
        before = scores
        for _ in range(CUT if rounds is None else min(CUT, rounds - turn)):
            turn += 1
            moved = (
                ways.join(scores.withColumnRenamed("host", "src"), ["kind", "src"])
                .select("kind", F.col("dst").alias("host"), (F.col("part") * F.col("score")).alias("score"))
            )
            scores = moved.unionByName(restart).groupBy("kind", "host").agg(F.sum("score").alias("score")).coalesce(tasks)
        scores = scores.checkpoint()
        both = scores.unionByName(before.select("kind", "host", (-F.col("score")).alias("score")))
        moves = both.groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("by"))
        change = moves.coalesce(tasks).agg(F.sum("by")).first()[0]
        if rounds is None and (change or 0.0) < tolerance:
            break
    return scores.groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.0,
    page_id: str = "page_id", url: str = "url", html: str = "html", tolerance: float = TOLERANCE,
) -> DataFrame:
    """A verdict for every page: ``page_id, host, path, rule, verdict, trust, distrust``.

    A NULL URL or one without ``://`` has an empty host and path, no edges, and, as no rule fits it,
    the verdict of a host with no evidence: allow. NULL HTML holds no links. Repeated rows
    and NULL ids are judged one by one; an empty table gives no rows. Other columns are not looked at.
    """
    host, path = host_and_path(url)
    links = F.transform(
        F.array_distinct(F.regexp_extract_all(text_or_empty(html), F.lit(_LINK), 1)),
        lambda x: F.regexp_replace(F.regexp_replace(lower_ascii(x), r"^[^@]*@", ""), r":[0-9]*$", ""),
    )
    judged = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.array_distinct(links).alias("links")
    )
    judged = stage(judged.withColumn("fit", rule_of("host", "path", rules)), "trust-pages")
    seeds = (
        judged.filter("fit is not null and host != ''")
        .groupBy("host", F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust").alias("kind"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    edges, seeds = stage(host_edges(judged), "trust-edges"), stage(seeds, "trust-found")
    # Written first, so that the pages of a hot host can be split over tasks.
    scores = stage(propagate(edges, seeds, tolerance=tolerance), "trust-scores")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when(distrust - trust > threshold, "block").otherwise("allow")
    return judged.join(scores, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
    )


def op8_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


QUERIES = {"op8_link_trust": op8_link_trust}
ORACLE: dict[str, str] = {}
