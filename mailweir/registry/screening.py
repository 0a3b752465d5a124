"""Header parsing, filters, outcomes and the ordered scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailweir.functions.dates import iso_to_day
from mailweir.functions.html import is_html
from mailweir.functions.text import nullish_default
from mailweir.operators import increment, profile, screen, sequence
from mailweir.operators.project import first_header, metadata, scan_headers, stamp_import
from mailweir.plans.ingest import scan_outcomes
from mailweir.registry import derive as D
from mailweir.registry.derive import (
    DATED_SQL, MATCH_SQL, day_of, day_sql, over_mail, over_scan, text_of, ts_sql,
)

#: The scan outcome an event stands for.
EVENT_OUTCOME = {
    "error": "cutoff", "view": "cutoff", "purchase": "success", "click": "filtered",
    "signup": "filtered",
}


def _scanned(spark, sf):
    return scan_headers(D.raw_documents(spark, sf))


def first_headers(spark, sf):
    headers = F.col("payload.headers")
    return D.raw_documents(spark, sf).select(
        "pos",
        first_header(headers, "From").alias("sender"),
        first_header(headers, "Subject").alias("subject"),
        first_header(headers, "Date").alias("date"),
    )


def parse_dates(spark, sf):
    return _scanned(spark, sf).select(
        "pos", text_of(F.col("parsed_ts")).alias("ts"), "tz_offset_min", "parsed_iso"
    )


def iso_days(spark, sf):
    """ISO text with its written offset, grouped by the UTC day it falls on."""
    days = _scanned(spark, sf).select(iso_to_day(F.col("parsed_iso")).alias("day"))
    return days.groupBy(day_of(F.col("day")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def cutoff(spark, sf):
    return screen.cutoff(_scanned(spark, sf), D.CUTOFF).select("pos")


def sender_allow(spark, sf):
    return screen.sender_allow(_scanned(spark, sf), D.ALLOW).select("pos", "id")


def sender_allow_long(spark, sf):
    """An allowlist that comes from a table, matched as a join."""
    entries = D.table(spark, sf, "documents").filter("lang <> 'en'").select(
        F.concat_ws("@", "source", "lang").alias("sender")
    ).distinct()
    return screen.sender_allow(D.mail(spark, sf), entries, inline=0).select("pos", "id")


def label_filter(spark, sf):
    return screen.label_filter(D.mail(spark, sf), ["FR", "ES"]).select("pos")


def missing_predicates(spark, sf):
    mail = D.mail(spark, sf)
    gone = screen.missing
    return mail.select(
        "pos", gone("parsed_ts").alias("no_date"), gone("content").alias("no_body"),
        gone("subject").alias("no_subject"),
    )


def subject_default(spark, sf):
    return D.mail(spark, sf).select(
        "pos", nullish_default(F.col("subject"), "No subject").alias("subject")
    )


def stamped(spark, sf):
    """The stamp is a time of day; what can be compared is that every row has the same one."""
    rows = stamp_import(D.mail(spark, sf))
    return rows.agg(
        F.count("_imported_at").alias("n"), (F.min("_imported_at") == F.max("_imported_at")).alias("one_stamp")
    )


def metadata_view(spark, sf):
    return metadata(D.mail(spark, sf)).select(
        "id", text_of(F.col("parsed_ts")).alias("ts"), F.col("from").alias("sender"), "subject"
    )


def html_flags(spark, sf):
    texts = D.table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("html").alias("t"))
    docs = D.table(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("text").alias("t"))
    return texts.unionAll(docs).groupBy("kind").agg(F.count_if(is_html(F.col("t"))).alias("n"))


def _outcomes(spark, sf, **options):
    known = D.mail(spark, sf).filter("lang = 'es'").select("id")
    return scan_outcomes(D.raw_documents(spark, sf), known, D.CUTOFF, D.ALLOW, **options)


def outcome(spark, sf):
    return _outcomes(spark, sf).select("pos", "id", "outcome")


def outcome_long(spark, sf):
    """The outcomes with the allowlist matched by joins, as a long one is."""
    return _outcomes(spark, sf, inline=0).select("pos", "id", "outcome")


def outcome_counts(spark, sf):
    return profile.outcome_counts(_outcomes(spark, sf))


def run_stats(spark, sf):
    return profile.run_stats(_outcomes(spark, sf))


def _event_scan(spark, sf):
    mapping = F.create_map(*[F.lit(x) for pair in EVENT_OUTCOME.items() for x in pair])
    return D.table(spark, sf, "events").select(
        F.col("user_id").alias("mailbox"), F.col("event_id").alias("pos"),
        F.try_element_at(mapping, F.col("event_type")).alias("outcome"),
    )


def early_stop(spark, sf):
    return sequence.early_stop(_event_scan(spark, sf))


def until_stop(spark, sf):
    scan = _event_scan(spark, sf)
    return sequence.until_stop(scan, sequence.early_stop(scan)).select("mailbox", "pos", "outcome")


#: Positions of a scan in milliseconds: a first one, and the distance of the next.
FIRST_MS, APART_MS = 1_700_000_000_000, 300_000


def sparse_stop(spark, sf):
    """Where scans stop whose positions are times, five minutes apart."""
    scan = _event_scan(spark, sf)
    return sequence.early_stop(scan.withColumn("pos", F.col("pos") * APART_MS + F.lit(FIRST_MS)))


def _plan(spark, sf, cut, mode):
    plan = increment.plan_increment(D.mail(spark, sf), cut, mode)
    return plan.select(
        F.lit(mode).alias("mode"), F.lit(cut[:10]).alias("cutoff"), "branch",
        day_of(F.col("after_day")).alias("after_day"),
        day_of(F.col("before_day")).alias("before_day"), "direction",
    )


def plan_increment(spark, sf):
    late = "2025-06-01T00:00:00+00:00"
    early = "2024-10-01T00:00:00+00:00"
    plans = [_plan(spark, sf, c, m) for c in (D.CUTOFF, late, early) for m in ("reference", "forward")]
    out = plans[0]
    for plan in plans[1:]:
        out = out.unionAll(plan)
    return out


def apply_increment(spark, sf):
    """The planned days of a run in reference mode, applied to the source."""
    mail = D.mail(spark, sf).withColumn("mail_date", F.to_date("parsed_ts"))
    plan = increment.plan_increment(mail, D.CUTOFF, "reference").first()
    return increment.apply_increment(mail, plan["after_day"], plan["before_day"]).select("pos")


QUERIES = {
    f.__name__: f
    for f in (
        first_headers, parse_dates, iso_days, cutoff, sender_allow, sender_allow_long,
        label_filter, missing_predicates, subject_default, stamped, metadata_view, html_flags,
        outcome, outcome_long, outcome_counts, run_stats, early_stop, until_stop, sparse_stop, plan_increment,
        apply_increment,
    )
}

_OUTCOMES = f"""flagged AS (
  SELECT *, {DATED_SQL} AS dated_ok, {MATCH_SQL} AS sender_ok FROM scanned),
firsts AS (
  SELECT *, min(pos) FILTER (dated_ok AND sender_ok) OVER (PARTITION BY id) AS first_kept FROM flagged),
outcomes AS (
  SELECT pos, id, CASE WHEN id IN (SELECT id FROM mail WHERE lang = 'es') THEN 'duplicate'
    WHEN pos > first_kept THEN 'duplicate' WHEN NOT dated_ok THEN 'cutoff'
    WHEN NOT sender_ok THEN 'filtered' ELSE 'success' END AS outcome FROM firsts)"""

_STOPS = """scan AS (
  SELECT user_id AS mailbox, event_id AS pos, CASE event_type WHEN 'error' THEN 'cutoff' WHEN 'view' THEN 'cutoff'
    WHEN 'purchase' THEN 'success' ELSE 'filtered' END AS outcome FROM events),
islands AS (
  SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY mailbox ORDER BY pos) AS island FROM scan),
runs AS (
  SELECT *, sum(CASE WHEN outcome = 'cutoff' THEN 1 ELSE 0 END) OVER (PARTITION BY mailbox, island ORDER BY pos) AS old FROM islands),
stops AS (SELECT mailbox, min(pos) AS stop_pos FROM runs WHERE old = 5 GROUP BY mailbox)"""


def _plan_sql(cut: str, mode: str) -> str:
    at = f"TIMESTAMP '{cut}'"
    gap = "INTERVAL 2 HOUR" if mode == "reference" else "INTERVAL 0 HOUR"
    hist = f"({'true' if mode == 'reference' else 'false'} AND {at} < max(ts))"
    return f"""SELECT '{mode}' AS mode, '{cut[:10]}' AS cutoff,
  CASE WHEN max(ts) IS NULL THEN 'initial' WHEN {hist} THEN 'historical' ELSE 'newer' END AS branch,
  CASE WHEN max(ts) IS NULL OR {hist} THEN {day_sql(at)} ELSE {day_sql('max(ts) + ' + gap)} END AS after_day,
  CASE WHEN {hist} THEN {day_sql('max(ts)')} END AS before_day,
  CASE WHEN {at} < min(ts) THEN 'backward' ELSE 'forward' END AS direction FROM mail"""


ORACLE = {
    "first_headers": over_scan("SELECT pos, sender, subject, header AS date FROM scanned"),
    "parse_dates": over_scan(
        f"SELECT pos, {ts_sql('ts')} AS ts, CASE WHEN ts IS NOT NULL THEN off END AS tz_offset_min, iso AS parsed_iso FROM scanned"
    ),
    "iso_days": over_scan(f"SELECT {day_sql('ts')} AS day, count(*) AS n FROM scanned GROUP BY 1"),
    "cutoff": over_scan(f"SELECT pos FROM scanned WHERE {DATED_SQL}"),
    "sender_allow": over_scan(f"SELECT pos, id FROM scanned WHERE {MATCH_SQL}"),
    "sender_allow_long": over_mail(
        """SELECT pos, id FROM mail WHERE sender IN (SELECT DISTINCT sender FROM (SELECT DISTINCT sender FROM mail) s,
  (SELECT DISTINCT source || '@' || lang AS entry FROM documents WHERE lang <> 'en') e WHERE contains(sender, entry))"""
    ),
    "label_filter": over_mail("SELECT pos FROM mail WHERE lang IN ('fr', 'es')"),
    "missing_predicates": over_mail(
        "SELECT pos, ts IS NULL AS no_date, content IS NULL AS no_body, subject IS NULL AS no_subject FROM mail"
    ),
    "subject_default": over_mail("SELECT pos, coalesce(subject, 'No subject') AS subject FROM mail"),
    "stamped": over_mail("SELECT count(*) AS n, true AS one_stamp FROM mail"),
    "metadata_view": over_mail(f"SELECT id, {ts_sql('ts')} AS ts, sender, subject FROM mail"),
    "html_flags": """SELECT kind, count(*) FILTER (regexp_matches(t, '<[^>]+>')) AS n FROM (
  SELECT 'page' AS kind, html AS t FROM pages UNION ALL SELECT 'doc', text FROM documents) GROUP BY kind""",
    "outcome": over_scan("SELECT pos, id, outcome FROM outcomes", _OUTCOMES),
    "outcome_long": over_scan("SELECT pos, id, outcome FROM outcomes", _OUTCOMES),
    "outcome_counts": over_scan(
        "SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome", _OUTCOMES
    ),
    "run_stats": over_scan(
        """SELECT count(*) FILTER (outcome = 'success') AS total_processed, count(*) FILTER (outcome = 'success') AS successful,
  count(*) FILTER (outcome IN ('duplicate', 'filtered')) AS skipped, count(*) FILTER (outcome = 'cutoff') AS cutoff,
  count(*) FILTER (outcome = 'error') AS errors FROM outcomes""", _OUTCOMES
    ),
    "early_stop": f"WITH {_STOPS} SELECT mailbox, stop_pos FROM stops",
    "until_stop": f"""WITH {_STOPS} SELECT s.mailbox, s.pos, s.outcome FROM scan s LEFT JOIN stops t ON s.mailbox = t.mailbox
WHERE t.stop_pos IS NULL OR s.pos <= t.stop_pos""",
    "sparse_stop": f"WITH {_STOPS} SELECT mailbox, stop_pos * {APART_MS} + {FIRST_MS} AS stop_pos FROM stops",
    "plan_increment": over_mail(
        "\nUNION ALL\n".join(
            _plan_sql(c, m)
            for c in ("2024-11-14 00:00:00", "2025-06-01 00:00:00", "2024-10-01 00:00:00")
            for m in ("reference", "forward")
        )
    ),
    "apply_increment": over_mail(
        """SELECT pos FROM mail WHERE ts IS NULL OR (CAST(ts AS DATE) >= DATE '2024-11-14'
  AND CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM mail))"""
    ),
}
