"""Insert-only loading into a mail table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day
from mailweir.operators.combine import first_wins, known_hits
from mailweir.operators.project import stamp_import
from mailweir.session import stage
from mailweir.sources import idindex
from mailweir.sources.tables import DAY, read_mail, settle, write_mail


@dataclass(frozen=True)
class LoadStats:
    """What a load did. Every row offered is in exactly one of the last three."""

    total_processed: int
    successful: int
    duplicates: int
    failed: int


def candidate_days(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored rows of the days the batch touches, for ids that never change their day.

    The days are a list, as many as the calendar has at most, so one message with an odd
    date adds its day and no other.
    """
    days = [r[0] for r in incoming.select(DAY).distinct().collect()]
    dated = [d for d in days if d is not None]
    inside = F.col(DAY).isin(dated) if dated else F.lit(False)
    return stored.filter(inside | F.col(DAY).isNull() if None in days else inside)


def arrival_order(incoming: DataFrame) -> list[Column]:
    """Earliest ``internalDate`` as a number first, without one last; ties by the whole record."""
    arrived = F.col("internalDate").try_cast("bigint").asc_nulls_last()
    return [arrived, F.xxhash64(*[F.col(f"`{c}`") for c in incoming.columns])]


def append_new(
    new: DataFrame, table: str, offered: int, failed: int = 0, at: dt.datetime | None = None,
    ids: DataFrame | None = None,
) -> LoadStats:
    """Append rows already known to be new and unique, and say how many there were."""
    added = write_mail(stamp_import(new, at), table, mode="append", ids=ids)
    return LoadStats(offered, added, offered - failed - added, failed)


def stored_ids(spark: SparkSession, table: str, ids: DataFrame, fixed_days: bool = False) -> DataFrame:
    """Which of the ids are stored, each once: by the table's index, or by its id column.

    ``fixed_days`` restricts the search of a table without an index to the days in ``ids``.
    """
    if idindex.exists(spark, table):
        idindex.recover(spark, table)
        return idindex.hits(spark, table, ids)
    stored = read_mail(spark, table)
    return known_hits(ids, candidate_days(stored, ids) if fixed_days else stored)


def load_insert_only(
    incoming: DataFrame, table: str, order: Sequence[str | Column] | None = None,
    fixed_days: bool = False, at: dt.datetime | None = None, index: bool = False,
) -> LoadStats:
    """Append the rows whose id the table lacks; of repeated ids the first in ``order``,
    by default that of arrival.

    The table is a plain folder, so uniqueness holds for one writer at a time.
    Loading the same rows again adds nothing, which makes a repeated or
    interrupted load safe. ``fixed_days`` states that a message keeps its day, so
    that only the days the batch touches are searched for its ids. A table with an index of
    ids is not searched; ``index`` makes one where there is none.
    """
    spark = incoming.sparkSession
    # Before anything is planned over the table: a replacement left unfinished is finished.
    settle(spark, table)
    offered = incoming if DAY in incoming.columns else incoming.withColumn(
        DAY, utc_day("parsed_ts")
    )
    if index and not idindex.exists(spark, table):
        idindex.build(spark, table)
    # Ids and days are read out once; what is counted and looked up, is so in them.
    heads = stage(offered.select("id", DAY), "load-heads")
    total, failed = heads.agg(F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    known = heads.filter(F.col("id").isNotNull())
    valid = offered.filter(F.col("id").isNotNull())
    hits, fresh = stored_ids(spark, table, known, fixed_days), None
    if idindex.exists(spark, table):
        hits = stage(hits, "load-hits")
        fresh = stage(known.select("id").distinct().join(hits, "id", "left_anti"), "load-fresh")
    # Once ids are unique no key is hot, and the anti-join reuses the partitioning this has made.
    new = first_wins(valid, order or arrival_order(valid)).join(hits, "id", "left_anti")
    return append_new(new, table, total, failed, at, fresh)


def sync(
    spark: SparkSession, source: str, target: str,
    order: Sequence[str | Column] | None = None, index: bool = False,
) -> tuple[LoadStats, bool]:
    """Insert into ``target`` what it lacks of ``source``; whether the counts then agree.

    Where both have an index of ids, only buckets that differ are looked into, and of the source
    only messages that the target lacks are offered.
    """
    settle(spark, source)
    a = read_mail(spark, source)
    if idindex.exists(spark, source) and idindex.exists(spark, target):
        for table in (source, target):
            idindex.recover(spark, table)
        buckets = idindex.differing(spark, source, target)
        here, there = (idindex.entries(spark, t, buckets).select("bucket", "id") for t in (source, target))
        lacking = stage(here.join(there, ["bucket", "id"], "left_anti").select("id").distinct(), "sync-lacking")
        a = a.join(lacking, "id", "left_semi")
    stats = load_insert_only(a, target, order, index=index)
    return stats, read_mail(spark, source).count() == read_mail(spark, target).count()
