"""Joins and set operations on message ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailweir.operators.skew import skew_join


def distinct_ids(mail: DataFrame, key: str = "id") -> DataFrame:
    return mail.select(key).distinct()


def known_hits(
    incoming: DataFrame, stored: DataFrame, key: str = "id", repeats: bool = False
) -> DataFrame:
    """Ids of incoming messages that are stored already.

    The store is the large side and an anti-join could only broadcast it. Asking
    the other way round lets a small batch be the broadcast side, so the store is
    scanned for its id column and not shuffled; a large batch is shuffled once.
    ``repeats`` says that one id may fill a large share of the store, which an
    insert-only table rules out; such an id is then reduced by each map task to one row.
    """
    ids = distinct_ids(stored, key) if repeats else stored.select(key)
    return ids.join(distinct_ids(incoming, key), key, "left_semi").distinct()


def skip_known(
    incoming: DataFrame, stored: DataFrame, key: str = "id", repeats: bool = False
) -> DataFrame:
    """Incoming messages whose id is not stored; repeats inside them stay."""
    hits = known_hits(incoming, stored, key, repeats)
    return skew_join(incoming, hits, key, "left_anti")


def first_wins(df: DataFrame, order: Sequence[str | Column], key: str = "id") -> DataFrame:
    """One row per id, the first in the given order.

    Each map task drops all but its own first row per id before the shuffle, so
    a heavily repeated id costs one row per task.
    """
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_turn", turn).filter("_turn = 1").drop("_turn")


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def difference(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of ``a`` that ``b`` lacks."""
    return distinct_ids(a, key).join(distinct_ids(b, key), key, "left_anti")


def merge_new(
    existing: DataFrame, new: DataFrame, dedup_new: Sequence[str | Column] | None = None
) -> DataFrame:
    """Existing messages and those new ones whose id is not among them.

    Repeats inside ``new`` all survive unless ``dedup_new`` gives an order, by
    which the first of each id is then kept.
    """
    if dedup_new is None:
        added = skip_known(new, existing, repeats=True)
    else:
        added = insertable(new, existing, dedup_new, repeats=True)
    return union_all(existing, added)


def insertable(
    incoming: DataFrame, stored: DataFrame, order: Sequence[str | Column], key: str = "id",
    repeats: bool = False, ids: DataFrame | None = None,
) -> DataFrame:
    """What an insert-only load adds: the first row of every id the store lacks.

    Once ids are unique no key is hot, and the anti-join reuses the partitioning
    the de-duplication has made. ``ids`` are those of the incoming rows, if they are
    at hand in a cheaper form.
    """
    hits = known_hits(incoming if ids is None else ids, stored, key, repeats)
    return first_wins(incoming, order, key).join(hits, key, "left_anti")


def sync_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Messages of ``a`` that have to be inserted into ``b``."""
    return skew_join(a, distinct_ids(b), "id", "left_anti")


def _presence(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Per id, how many rows each side has: one shuffle of pre-aggregated ids, no join."""
    tag = lambda df, in_a, in_b: df.select(
        key, F.lit(in_a).alias("_a"), F.lit(in_b).alias("_b")
    )
    return (
        tag(a, 1, 0).unionAll(tag(b, 0, 1)).groupBy(key)
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )


def reconcile(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """One row: ids only in ``a``, ids only in ``b``, and whether the sets differ."""
    only_a = F.count_if((F.col("_a") > 0) & (F.col("_b") == 0))
    only_b = F.count_if((F.col("_b") > 0) & (F.col("_a") == 0))
    return _presence(a, b, key).agg(
        only_a.alias("only_in_a"), only_b.alias("only_in_b"),
        ((only_a > 0) | (only_b > 0)).alias("inconsistent"),
    )


def sets_equal(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    return reconcile(a, b, key).select((~F.col("inconsistent")).alias("equal"))


def verify_gate(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """One row: both counts, and whether counts and id sets agree."""
    differing = F.count_if((F.col("_a") > 0) != (F.col("_b") > 0))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return _presence(a, b, key).agg(
        count("_a").alias("count_a"), count("_b").alias("count_b"),
        differing.alias("ids_differing"),
        ((count("_a") == count("_b")) & (differing == 0)).alias("passed"),
    )
