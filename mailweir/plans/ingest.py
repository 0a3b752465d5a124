"""Raw messages to stored mail: screen, decode, merge, load, report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.dates import with_mail_date
from mailweir.operators.combine import first_wins
from mailweir.operators.increment import apply_increment, plan_increment
from mailweir.operators.profile import run_stats
from mailweir.operators.project import named_headers, scan_headers, to_mail
from mailweir.operators.screen import INLINE_ENTRIES, as_instant, cutoff, outcome, sender_allow
from mailweir.operators.sequence import early_stop, until_stop
from mailweir.plans import dayprofile
from mailweir.plans.verify import stored_status
from mailweir.session import stage
from mailweir.sources import idindex
from mailweir.sources.load import LoadStats, append_new, stored_ids, sync
from mailweir.sources.runlog import log_rows, write_run_log, write_run_stats
from mailweir.sources.snapshots import due, moment_of, retain, snapshot, snapshots
from mailweir.sources.tables import read_mail, settle


def screened_mail(
    raw: DataFrame, moment: dt.datetime | str, allow: DataFrame | Sequence[str], *extra: str
) -> DataFrame:
    """Mail records of the messages that pass allowlist and cutoff.

    Cheapest test first: senders are compared before dates are parsed, and bodies
    are decoded for what is kept. Nothing is shuffled up to here.
    """
    allowed = sender_allow(named_headers(raw), allow)
    return to_mail(cutoff(with_mail_date(allowed, "date"), moment), *extra)


def scan_outcomes(
    raw: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], moment: dt.datetime | str,
    allow: DataFrame | Sequence[str], pos: str = "pos", inline: int = INLINE_ENTRIES,
) -> DataFrame:
    """The outcome of every scanned message; bodies are not read.

    Telling copies apart looks at the scan several times, so its few columns are
    staged: the raw messages are read and their headers parsed once.
    """
    scanned = stage(
        scan_headers(raw).select("id", pos, "from", "subject", "parsed_ts", "parsed_iso"), "scan"
    )
    return outcome(scanned, known, moment, allow, pos, inline)


@dataclass(frozen=True)
class RunPaths:
    """Where one mail collection lives."""

    table: str
    snapshots: str
    run_log: str
    run_stats: str


def _snapshot_if_due(
    spark: SparkSession, paths: RunPaths, now: dt.datetime, every: dt.timedelta, keep: int | None
) -> None:
    taken = snapshots(spark, paths.snapshots)
    if due(moment_of(taken[-1]) if taken else None, now, every, force=False):
        snapshot(spark, paths.table, paths.snapshots, now)
    if keep is not None:
        retain(spark, paths.snapshots, keep)


def run_ingest(
    spark: SparkSession, raw: DataFrame, paths: RunPaths, moment: dt.datetime | str,
    allow: DataFrame | Sequence[str], pos: str = "pos", run_id: str | None = None,
    stop_after: int | None = None, snapshot_every: dt.timedelta = dt.timedelta(0),
    keep_snapshots: int | None = None, day: str | None = None, mode: str = "forward",
    mirror: str | None = None, index: bool = False, profile: bool = False,
) -> LoadStats:
    """One batch run: snapshot the table, log every outcome, load what is new, verify.

    ``day`` names the column of ``raw`` by which the landing is partitioned. Only the days that
    the planned increment asks for are then read, in the given ``mode``, and messages without a day.
    ``mirror`` is a second store: after the load it is given what it lacks, both are compared, and
    the run's statistics say whether they agree. ``index`` gives the table an index of its ids; so
    does a mirror, which by them is compared without reading ids that both have. ``profile`` brings
    the table's profile up to date, from the files that the load has added.

    A snapshot is taken once ``snapshot_every`` has passed since the last one; with
    ``keep_snapshots`` only that many are kept.

    ``raw`` carries the scan position in ``pos``, a number that decides which of
    several copies of a message is kept. With ``stop_after`` the scan ends at that many
    messages older than the cutoff with none kept between them; without it every
    message is looked at, in whatever order they have landed.
    """
    run_id = run_id or uuid.uuid4().hex
    started = dt.datetime.now(dt.timezone.utc)
    settle(spark, paths.table)
    if (index or mirror) and not idindex.exists(spark, paths.table):
        idindex.build(spark, paths.table)
    stored = read_mail(spark, paths.table)
    before = stored.count()
    plan = plan_increment(stored, moment, mode).first()
    if day is not None:
        raw = apply_increment(raw, plan["after_day"], plan["before_day"], day)
    outcomes = stage(
        scan_outcomes(raw, lambda ids: stored_ids(spark, paths.table, ids), moment, allow, pos), "outcomes"
    )
    if stop_after is not None:
        scan = outcomes.withColumn("mailbox", F.lit("all"))
        stops = early_stop(scan, pos=pos, limit=stop_after)
        outcomes = stage(until_stop(scan, stops, pos=pos).drop("mailbox"), "outcomes")
    write_run_log(log_rows(outcomes, run_id), paths.run_log)
    _snapshot_if_due(spark, paths, started, snapshot_every, keep_snapshots)

    # The outcomes name every message to be stored, one per id. A short list of them is
    # broadcast, so that no body is shuffled; a long one meets the bodies on unique keys.
    kept = outcomes.filter(F.col("outcome") == "success").select("id", pos)
    listed, ids = kept.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    new = screened_mail(raw, moment, allow, pos).join(kept, ["id", pos], "left_semi")
    if listed != ids:
        # Copies of a message share a scan position, so it did not tell them apart.
        new = first_wins(new, [pos])
    stats = append_new(new, paths.table, listed, ids=kept.select("id").distinct())
    if profile:
        dayprofile.refresh(spark, paths.table)
    status = None
    if mirror is not None:
        sync(spark, paths.table, mirror, index=True)
        status = stored_status(spark, paths.table, mirror).first()["status"]

    summary = run_stats(outcomes).select(
        "*",
        F.lit(run_id).alias("run_id"),
        F.lit(started).alias("start_time"),
        F.current_timestamp().alias("end_time"),
        as_instant(moment).alias("cutoff_date"),
        F.lit(plan["earliest"]).cast("timestamp").alias("existing_earliest"),
        F.lit(plan["latest"]).cast("timestamp").alias("existing_latest"),
        F.lit(plan["direction"]).alias("direction"),
        F.lit(before).alias("count_before"),
        F.lit(stats.successful).alias("count_new"),
        F.lit(before + stats.successful).alias("count_after"),
        F.lit(plan["branch"]).alias("branch"),
        F.lit(plan["after_day"]).cast("date").alias("after_day"),
        F.lit(plan["before_day"]).cast("date").alias("before_day"),
        F.lit(status).cast("string").alias("status"),
    )
    write_run_stats(summary, paths.run_stats)
    return stats
