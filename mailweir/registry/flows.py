"""Sources and sinks: what is written to the shared folder is read back and returned."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day, with_mail_date
from mailweir.operators import screen
from mailweir.operators.project import named_headers, scan_headers
from mailweir.plans.ingest import RunPaths, run_ingest
from mailweir.registry import derive as D
from mailweir.registry.derive import day_of, day_sql, over_mail, over_scan, over_stores, text_of, ts_sql
from mailweir.registry.screening import _OUTCOMES, _outcomes
from mailweir.session import run_dir
from mailweir.sources import allowlist, idindex, load, runlog, snapshots, tables
from mailweir.sources import raw as raw_files

AT = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def _shown(mail):
    return mail.select(
        "id", "threadId", F.col("from").alias("sender"), "subject",
        text_of(F.col("parsed_ts")).alias("ts"), day_of(F.col("mail_date")).alias("day"),
    ).withColumnRenamed("threadId", "thread")


def read_raw(spark, sf):
    """Raw messages landed as JSON lines and read with the explicit schema."""
    path = run_dir(spark, "raw")
    raw_files.write_raw(D.raw_documents(spark, sf), path)
    scanned = scan_headers(raw_files.read_raw(spark, path))
    return scanned.select(
        "id", "threadId", "internalDate", "snippet", F.array_join("labelIds", ",").alias("labels"),
        F.col("from").alias("sender"), "subject", "date",
    ).withColumnRenamed("threadId", "thread").withColumnRenamed("internalDate", "internal")


def write_mail(spark, sf):
    """A table partitioned by day, read back."""
    path = run_dir(spark, "mail")
    tables.write_mail(D.mail(spark, sf), path)
    return _shown(tables.read_mail(spark, path))


def read_mail_days(spark, sf):
    """A range of days, which reads only those folders."""
    path = run_dir(spark, "mail")
    tables.write_mail(D.mail(spark, sf), path)
    days = F.col("mail_date").between(F.lit("2024-11-10").cast("date"), F.lit("2024-11-20").cast("date"))
    return _shown(tables.read_mail(spark, path).filter(days))


def _json_records(spark, sf):
    iso = F.date_format("parsed_ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return D.mail_records(spark, sf).withColumn("parsed_iso", iso)


def _json_shown(back):
    return back.select(
        "id", F.col("from").alias("sender"), text_of(F.col("parsed_ts")).alias("ts"),
        "tz_offset_min", F.col("body").isNull().alias("no_body"),
        F.coalesce(F.size("body.urls"), F.lit(0)).alias("n_urls"),
    )


def mail_json(spark, sf):
    """Records exported in the interchange layout and read back."""
    path = run_dir(spark, "mail-json")
    tables.write_mail_json(_json_records(spark, sf), path)
    return _json_shown(tables.read_mail_json(spark, path))


def mail_json_array(spark, sf):
    """Records exported as arrays, and read back by their quotes and braces."""
    path = run_dir(spark, "mail-json")
    tables.write_mail_json(_json_records(spark, sf), path, layout="array")
    return _json_shown(tables.read_mail_json(spark, path, layout="array"))


def snapshot_restore(spark, sf):
    """A snapshot survives the table it was taken from being overwritten."""
    table, root = run_dir(spark, "mail"), run_dir(spark, "snapshots")
    mail = D.mail(spark, sf)
    tables.write_mail(D.store_a(mail), table)
    snapshots.snapshot(spark, table, root, AT)
    tables.write_mail(D.store_b(mail), table)
    snapshots.snapshot(spark, table, root, AT + dt.timedelta(hours=1))
    snapshots.restore(spark, root, table, snapshots.snapshots(spark, root)[0])
    return _shown(tables.read_mail(spark, table))


def load_insert_only(spark, sf):
    """Load one store into a table that holds the other; loading it again adds nothing."""
    table = run_dir(spark, "mail")
    mail = D.mail(spark, sf)
    load.load_insert_only(D.store_a(mail), table, ["pos"])
    load.load_insert_only(D.store_b(mail), table, ["pos"])
    load.load_insert_only(D.store_b(mail), table, ["pos"], fixed_days=True)
    return tables.read_mail(spark, table).select(
        "id", text_of(F.col("parsed_ts")).alias("ts"), F.col("_imported_at").isNotNull().alias("stamped")
    )


def load_indexed(spark, sf):
    """The same loads by the table's index of ids, whose files are merged in between."""
    table = run_dir(spark, "mail")
    mail = D.mail(spark, sf)
    load.load_insert_only(D.store_a(mail), table, ["pos"], index=True)
    load.load_insert_only(D.store_b(mail), table, ["pos"])
    idindex.compact(spark, table)
    load.load_insert_only(D.store_b(mail), table, ["pos"])
    stored = tables.read_mail(spark, table)
    filed = idindex.hits(spark, table, stored.select("id"))
    return stored.join(filed, "id").select(
        "id", text_of(F.col("parsed_ts")).alias("ts"), F.col("_imported_at").isNotNull().alias("stamped")
    )


def load_counts(spark, sf):
    """The counts two loads report."""
    table = run_dir(spark, "mail")
    mail = D.mail(spark, sf)
    runs = [
        ("first", load.load_insert_only(D.store_a(mail), table, ["pos"])),
        ("second", load.load_insert_only(D.store_b(mail), table, ["pos"])),
    ]
    return spark.createDataFrame(
        [(n, s.total_processed, s.successful, s.duplicates, s.failed) for n, s in runs],
        "load string, total_processed bigint, successful bigint, duplicates bigint, failed bigint",
    )


def load_ties(spark, sf):
    """Copies arrive at times of differing lengths; the numerically earliest is stored."""
    table = run_dir(spark, "mail")
    arrived = (F.col("pos") % 13 + 1) * F.pow(F.lit(10), F.col("pos") % 5).cast("bigint")
    load.load_insert_only(D.mail(spark, sf).withColumn("internalDate", arrived.cast("string")), table)
    return tables.read_mail(spark, table).select("id", F.col("internalDate").alias("internal"))


def sync_stores(spark, sf):
    """The second store after it has been given what it lacks of the first."""
    source, target = run_dir(spark, "mail"), run_dir(spark, "mail")
    mail = D.mail(spark, sf)
    tables.write_mail(D.store_a(mail), source)
    load.load_insert_only(D.store_b(mail), target, ["pos"])
    load.sync(spark, source, target, ["id"])
    return tables.read_mail(spark, target).select("id", text_of(F.col("parsed_ts")).alias("ts"))


def read_allowlist(spark, sf):
    """An allowlist kept as a JSON file, applied to all mail."""
    path = run_dir(spark, "allow")
    entries = spark.createDataFrame([(e,) for e in D.ALLOW], "sender string")
    allowlist.write_allowlist(entries, path)
    return screen.sender_allow(D.mail(spark, sf), allowlist.read_allowlist(spark, path)).select("pos", "id")


def run_log(spark, sf):
    """The log of a scan, written and read back."""
    path = run_dir(spark, "run-log")
    runlog.write_run_log(runlog.log_rows(_outcomes(spark, sf), "r1"), path)
    return runlog.read_run_log(spark, path).select("message_id", "status", "subject", "date")


def ingest_run(spark, sf):
    """Two whole runs, plain mail and then web pages; the second run's table."""
    root = run_dir(spark, "run")
    paths = RunPaths(f"{root}/mail", f"{root}/snapshots", f"{root}/log", f"{root}/stats")
    run_ingest(spark, D.raw_documents(spark, sf), paths, D.CUTOFF, D.ALLOW, run_id="r1")
    run_ingest(spark, D.raw_pages(spark, sf), paths, D.CUTOFF, ["example.com"], run_id="r2")
    return tables.read_mail(spark, paths.table).select(
        "id", "subject", text_of(F.col("parsed_ts")).alias("ts"), "parsed_iso"
    )


def ingest_stats(spark, sf):
    """What the two runs report about themselves."""
    root = run_dir(spark, "run")
    paths = RunPaths(f"{root}/mail", f"{root}/snapshots", f"{root}/log", f"{root}/stats")
    run_ingest(spark, D.raw_documents(spark, sf), paths, D.CUTOFF, D.ALLOW, run_id="r1")
    run_ingest(spark, D.raw_documents(spark, sf), paths, D.CUTOFF, D.ALLOW, run_id="r2")
    return runlog.read_run_stats(spark, paths.run_stats).select(
        "run_id", "direction", text_of(F.col("existing_latest")).alias("existing_latest"),
        "total_processed", "successful", "skipped", "cutoff", "errors",
        "count_before", "count_new", "count_after",
    )


def _landing(spark, sf):
    """Raw mail in a folder per day it is from; mail without a date in one of its own."""
    path = run_dir(spark, "landing")
    raw = D.raw_documents(spark, sf)
    dated = with_mail_date(named_headers(raw), "date").withColumn("landed", utc_day("parsed_ts"))
    dated.select(*raw.columns, "landed").write.partitionBy("landed").parquet(path)
    return spark.read.parquet(path)


def run_window(spark, sf):
    """Runs that read the planned days of the landing only, and the store that mirrors the table."""
    root = run_dir(spark, "run")
    paths = RunPaths(f"{root}/mail", f"{root}/snapshots", f"{root}/log", f"{root}/stats")
    raw = _landing(spark, sf)
    for run_id in ("r1", "r2"):
        run_ingest(spark, raw, paths, D.CUTOFF, D.ALLOW, run_id=run_id, day="landed", mirror=f"{root}/mirror")
    return tables.read_mail(spark, f"{root}/mirror").select(
        "id", "subject", text_of(F.col("parsed_ts")).alias("ts"), "parsed_iso"
    )


def run_gate(spark, sf):
    """The windows that two runs plan, and how they end."""
    root = run_dir(spark, "run")
    paths = RunPaths(f"{root}/mail", f"{root}/snapshots", f"{root}/log", f"{root}/stats")
    raw = _landing(spark, sf)
    for run_id in ("r1", "r2"):
        run_ingest(
            spark, raw, paths, D.CUTOFF, D.ALLOW, run_id=run_id, day="landed", mode="reference", mirror=f"{root}/mirror"
        )
    return runlog.read_run_stats(spark, paths.run_stats).select(
        "run_id", "branch", day_of(F.col("after_day")).alias("after_day"),
        day_of(F.col("before_day")).alias("before_day"), "status", "count_after",
    )


QUERIES = {
    f.__name__: f
    for f in (
        read_raw, write_mail, read_mail_days, mail_json, mail_json_array, snapshot_restore, load_insert_only,
        load_indexed, load_counts, load_ties, sync_stores, read_allowlist, run_log, ingest_run, ingest_stats,
        run_window, run_gate,
    )
}

_SHOWN = f"id, thread, sender, subject, {ts_sql('ts')} AS ts, {day_sql('ts')} AS day"
_LOADED = """first_a AS (SELECT id, any_value(ts) AS ts FROM a GROUP BY id),
first_b AS (SELECT id, any_value(ts) AS ts FROM b WHERE id NOT IN (SELECT id FROM a) GROUP BY id)"""
# What a run keeps follows from its text, but for sender, which copies may differ in.
_KEPT = f"kept AS (SELECT * FROM scanned WHERE {D.DATED_SQL} AND {D.MATCH_SQL})"
#: The outcomes of two runs over the same messages.
RUNS_SQL = f"""flagged AS (SELECT *, {D.DATED_SQL} AS dated_ok, {D.MATCH_SQL} AS sender_ok FROM scanned),
firsts AS (SELECT *, min(pos) FILTER (dated_ok AND sender_ok) OVER (PARTITION BY id) AS first_kept FROM flagged),
run1 AS (SELECT *, CASE WHEN pos > first_kept THEN 'duplicate' WHEN NOT dated_ok THEN 'cutoff'
  WHEN NOT sender_ok THEN 'filtered' ELSE 'success' END AS outcome FROM firsts),
run2 AS (SELECT *, CASE WHEN first_kept IS NOT NULL THEN 'duplicate' WHEN NOT dated_ok THEN 'cutoff'
  WHEN NOT sender_ok THEN 'filtered' ELSE 'success' END AS outcome FROM firsts)"""
_N = "count(*) FILTER (outcome = '{0}')"
_STATS = """{success} AS total_processed, {success} AS successful, {duplicate} + {filtered} AS skipped,
  {cutoff} AS cutoff, CAST(0 AS BIGINT) AS errors""".format(
    **{n: _N.format(n) for n in ("success", "duplicate", "filtered", "cutoff")}
)
_EARLIEST = "(SELECT min(ts) FROM run1 WHERE outcome = 'success')"
_LATEST = "(SELECT max(ts) FROM run1 WHERE outcome = 'success')"

ORACLE = {
    "read_raw": over_scan(
        """SELECT id, thread, lpad(CAST(pos AS VARCHAR), 20, '0') AS internal, source AS snippet, upper(lang) AS labels,
  sender, subject, header AS date FROM scanned"""
    ),
    "write_mail": over_mail(f"SELECT {_SHOWN} FROM mail"),
    "read_mail_days": over_mail(
        f"SELECT {_SHOWN} FROM mail WHERE CAST(ts AS DATE) BETWEEN DATE '2024-11-10' AND DATE '2024-11-20'"
    ),
    "mail_json": over_mail(
        f"""SELECT id, sender, {ts_sql('ts')} AS ts, CASE WHEN ts IS NOT NULL THEN 0 END AS tz_offset_min,
  content IS NULL AS no_body, CASE WHEN content IS NOT NULL AND n_chars % 3 = 0 THEN 2 ELSE 0 END AS n_urls FROM mail"""
    ),
    "mail_json_array": over_mail(
        f"""SELECT id, sender, {ts_sql('ts')} AS ts, CASE WHEN ts IS NOT NULL THEN 0 END AS tz_offset_min,
  content IS NULL AS no_body, CASE WHEN content IS NOT NULL AND n_chars % 3 = 0 THEN 2 ELSE 0 END AS n_urls FROM mail"""
    ),
    "snapshot_restore": over_stores(f"SELECT {_SHOWN} FROM a"),
    "load_insert_only": over_stores(
        f"""SELECT id, {ts_sql('ts')} AS ts, true AS stamped FROM (
  SELECT * FROM first_a UNION ALL SELECT * FROM first_b)""", _LOADED
    ),
    "load_indexed": over_stores(
        f"""SELECT id, {ts_sql('ts')} AS ts, true AS stamped FROM (
  SELECT * FROM first_a UNION ALL SELECT * FROM first_b)""", _LOADED
    ),
    "load_counts": over_stores(
        """SELECT 'first' AS load, (SELECT count(*) FROM a) AS total_processed, count(*) AS successful,
  (SELECT count(*) FROM a) - count(*) AS duplicates, CAST(0 AS BIGINT) AS failed FROM first_a
UNION ALL SELECT 'second', (SELECT count(*) FROM b), count(*), (SELECT count(*) FROM b) - count(*), 0 FROM first_b""",
        _LOADED,
    ),
    "load_ties": over_mail(
        """SELECT id, CAST(min((pos % 13 + 1) * CAST(pow(10, pos % 5) AS BIGINT)) AS VARCHAR) AS internal FROM mail GROUP BY id"""
    ),
    "sync_stores": over_stores(
        f"SELECT id, {ts_sql('any_value(ts)')} AS ts FROM (SELECT id, ts FROM a UNION ALL SELECT id, ts FROM b) GROUP BY id"
    ),
    "read_allowlist": over_mail(f"SELECT pos, id FROM mail WHERE {D.MATCH_SQL}"),
    "run_log": over_scan(
        """SELECT o.id AS message_id, outcome AS status, CASE WHEN outcome = 'success' THEN subject END AS subject,
  CASE WHEN outcome = 'success' THEN iso END AS date FROM outcomes o JOIN scanned s ON o.pos = s.pos""", _OUTCOMES
    ),
    "ingest_run": over_scan(
        f"""SELECT id, any_value(subject) AS subject, {ts_sql('any_value(ts)')} AS ts, any_value(iso) AS parsed_iso FROM kept GROUP BY id
UNION ALL SELECT 'p' || md5(html), min_by(url, page_id), NULL, NULL FROM pages
WHERE contains(regexp_extract(url, '^https?://([^/]+)', 1), 'example.com') GROUP BY 1""", _KEPT
    ),
    "run_window": over_scan(
        f"SELECT id, any_value(subject) AS subject, {ts_sql('any_value(ts)')} AS ts, any_value(iso) AS parsed_iso FROM kept GROUP BY id",
        _KEPT,
    ),
    "run_gate": over_scan(
        f"""SELECT 'r1' AS run_id, 'initial' AS branch, '2024-11-14' AS after_day, CAST(NULL AS VARCHAR) AS before_day,
  'completed' AS status, count(DISTINCT id) AS count_after FROM kept
UNION ALL SELECT 'r2', CASE WHEN max(ts) > TIMESTAMP '2024-11-14' THEN 'historical' ELSE 'newer' END,
  CASE WHEN max(ts) > TIMESTAMP '2024-11-14' THEN '2024-11-14' ELSE {day_sql("max(ts) + INTERVAL 2 HOUR")} END,
  CASE WHEN max(ts) > TIMESTAMP '2024-11-14' THEN {day_sql('max(ts)')} END, 'completed', count(DISTINCT id) FROM kept""", _KEPT
    ),
    "ingest_stats": over_scan(
        f"""SELECT 'r1' AS run_id, 'forward' AS direction, CAST(NULL AS VARCHAR) AS existing_latest, {_STATS},
  CAST(0 AS BIGINT) AS count_before, {_N.format('success')} AS count_new, {_N.format('success')} AS count_after FROM run1
UNION ALL SELECT 'r2', CASE WHEN TIMESTAMP '2024-11-14' < {_EARLIEST} THEN 'backward' ELSE 'forward' END,
  {ts_sql(_LATEST)}, {_STATS}, (SELECT {_N.format('success')} FROM run1), CAST(0 AS BIGINT),
  (SELECT {_N.format('success')} FROM run1) FROM run2""", RUNS_SQL
    ),
}
