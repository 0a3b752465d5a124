"""Mixing sources to target weights by cube-method balanced sampling.

Every document has an expected number of copies, its source's target over its
source's size. The whole part is taken for certain; the fraction is an inclusion
probability, which the cube method rounds to 0 or 1 so that each source keeps its
expected number of words and of documents.

*Flight*: three undecided documents at a time are moved along the one direction
that changes neither total, until one of them reaches 0 or 1. The direction's sign
is drawn so that expectations stay. A chunk of documents ends with at most two
undecided ones. Chunks of one source run side by side; what they leave over is
chunked again, until one chunk holds all that is left of a source. *Landing*: that
chunk rounds its last two documents to the combination nearest to the word total. Long
documents fly first, so those two are short.

A hot source only has more chunks. Sources, not documents, are ranked in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.llm.common import WORD, table, text_or_empty
from mailweir.session import run_dir, stage

#: Documents of one flight, which one task holds (narrow rows only).
CHUNK = 8192
_TINY = 1e-9


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """One row per source: its size and the words it shall give.

    Sources in code point order, NULL last, weigh ``weights``, repeating. They share
    ``share`` times all sizes; a target stops at ``most`` times its source's size and
    the rest is shared by weight among the others. That is one level L with
    ``target = min(cap, weight * L)``: with sources sorted by cap over weight, L is what
    is left after the first k caps over the weights left, at the first k for which the
    next source stays below its cap.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(cycle, F.pmod("sid", F.lit(len(weights)))))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    capped, lighter = (
        F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("cap", "weight")
    )
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - capped) / (
        F.sum("weight").over(everything) - lighter
    )
    levels = ranked.withColumn("level", level)
    holds = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))
    reached = F.min(holds).over(everything)["level"]
    target = F.when(reached.isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * reached)
    )
    return levels.withColumn("target", target).select("source", "sid", "source_size", "target")


def _fly(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> list[int]:
    """Round ``p`` in place, keeping sum(p) and sum(p * size); returns the undecided."""
    chance = iter(draw.random(2 * len(p) + 8).tolist())
    prob, weight = p.tolist(), size.tolist()
    held: list[int] = []
    for i in range(len(prob)):
        if _TINY < prob[i] < 1 - _TINY:
            held.append(i)
        while len(held) >= 3 or len(held) == 2 and weight[held[0]] == weight[held[1]]:
            if len(held) == 2:
                way = (1.0, -1.0)
            else:
                a, b, c = (weight[k] for k in held)
                way = (b - c, c - a, a - b)
                if not any(way):
                    way = (1.0, -1.0, 0.0)
            up = min((1 - prob[k]) / v if v > 0 else prob[k] / -v for k, v in zip(held, way) if v)
            down = min(prob[k] / v if v > 0 else (1 - prob[k]) / -v for k, v in zip(held, way) if v)
            step = up if next(chance) * (up + down) < down else -down
            for k, v in zip(held, way):
                prob[k] += step * v
                if prob[k] <= _TINY:
                    prob[k] = 0.0
                elif prob[k] >= 1 - _TINY:
                    prob[k] = 1.0
            held = [k for k in held if 0.0 < prob[k] < 1.0]
    p[:] = np.round(prob, 15)
    return held


def _land(p: np.ndarray, size: np.ndarray, held: list[int], u: float) -> None:
    """Round the last undecided documents, at most two, nearest to their words."""
    words = float((p[held] * size[held]).sum())
    ways = [[(way >> k) & 1 for k in range(len(held))] for way in range(1 << len(held))]
    error = [abs(float(np.dot(w, size[held])) - words) + abs(sum(w) - p[held].sum()) for w in ways]
    best = [w for w, e in zip(ways, error) if e <= min(error) + _TINY]
    p[held] = best[int(u * len(best)) % len(best)]


def _balance(seed: int, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Long documents first: what is left to land is short.
        rows = rows.sort_values(["size", "u"], ascending=[False, True], kind="stable").reset_index(drop=True)
        p, size = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
        draw = np.random.default_rng([seed, turn, int(rows["sid"][0]), int(rows["chunk"][0])])
        p[p <= _TINY], p[p >= 1 - _TINY] = 0.0, 1.0
        held = _fly(p, size, draw)
        if held and rows["chunks"][0] == 1:
            _land(p, size, held, float(draw.random()))
        return rows.assign(p=p)

    return run


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 20, chunk: int = CHUNK,
) -> DataFrame:
    """Copies of each document for a mix of the wanted words per source.

    Returns one row per input row: ``doc_id, source, size, source_size, target, copies,
    taken`` (``copies * size``). ``most`` is a whole number of copies at most. A NULL or
    empty text has size 0 and is never taken; a NULL source is a source of its own, the
    last; repeated rows are separate documents; a NULL ``doc_id`` is kept; an empty table gives
    no rows. Other columns are not looked at. The same rows give the same mix.
    """
    spark = docs.sparkSession
    sizes = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size")
        ),
        "mix-sizes",
    )
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets")
    expected = F.col("target") / F.col("source_size")
    units = (
        sizes.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select(
            "doc_id", "d.source", "size", "sid", "source_size", "target",
            F.xxhash64("doc_id", F.lit(seed)).alias("u"),
            F.coalesce(F.when(F.col("size") > 0, expected), F.lit(0.0)).alias("e"),
        )
        .withColumn("base", F.floor("e").cast("int"))
        .withColumn("p", F.col("e") - F.col("base"))
        .drop("e")
    )
    done: list[DataFrame] = []
    turn = 0
    while True:
        flown = _flight(spark, units, seed, turn, chunk)
        decided = (F.col("p") == 0.0) | (F.col("p") == 1.0)
        done.append(flown.filter(decided))
        units = flown.filter(~decided)
        turn += 1
        if units.isEmpty():
            break
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    copies = F.col("base") + F.col("p").cast("int")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _flight(spark: SparkSession, units: DataFrame, seed: int, turn: int, chunk: int) -> DataFrame:
    """One round: chunk what is undecided, fly each chunk, write the rows."""
    counts = units.groupBy("sid").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("chunks"))
    chunked = units.join(stage(counts, "mix-counts"), "sid").withColumn(
        "chunk", F.pmod(F.xxhash64("u", "size", F.lit(turn)), F.col("chunks")).cast("int")
    )
    # Dealt by chunk, or the join's partitioning by source would put a hot source in one task.
    chunked = chunked.repartition("sid", "chunk")
    flown = chunked.groupBy("sid", "chunk").applyInPandas(_balance(seed, turn), chunked.schema)
    path = run_dir(spark, f"mix-{turn}")
    flown.write.parquet(path)
    return spark.read.schema(flown.schema).parquet(path).drop("chunk", "chunks")


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


QUERIES = {"op1_cube_mix": op1_cube_mix}
ORACLE: dict[str, str] = {}
