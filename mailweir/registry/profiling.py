"""Aggregations, top-k and ordering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from mailweir.operators import order, profile, sequence
from mailweir.operators.screen import as_instant
from mailweir.plans import dayprofile
from mailweir.plans.verify import quality_report as report_of
from mailweir.plans.verify import summary
from mailweir.registry import derive as D
from mailweir.registry.derive import day_of, day_sql, over_mail, text_of, ts_sql
from mailweir.session import run_dir
from mailweir.sources import tables

AS_OF = "2025-01-01T00:00:00+00:00"


def total(spark, sf):
    return profile.total(D.mail(spark, sf))


def date_range(spark, sf):
    return profile.date_range(D.mail(spark, sf)).select(
        text_of(F.col("earliest")).alias("earliest"), text_of(F.col("latest")).alias("latest")
    )


def latest_date(spark, sf):
    return profile.latest_date(D.mail(spark, sf)).select(text_of(F.col("latest")).alias("latest"))


def freshness(spark, sf):
    return profile.freshness(D.mail(spark, sf), as_instant(AS_OF))


def top_senders(spark, sf):
    return profile.top_senders(D.mail(spark, sf)).withColumnRenamed("from", "sender")


def daily(spark, sf):
    return profile.daily(D.mail(spark, sf)).select(day_of(F.col("day")).alias("day"), "n")


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def content_stats(spark, sf):
    stats = profile.content_stats(D.mail_records(spark, sf))
    return _rounded(stats, "avg_length", "avg_urls")


def quality_summary(spark, sf):
    report = summary(D.mail_records(spark, sf))
    return _rounded(report, "avg_length", "avg_urls").withColumns(
        {"earliest": text_of(F.col("earliest")), "latest": text_of(F.col("latest"))}
    )


_WHOLE = ("min_length", "max_length", "total_urls", "missing_dates", "missing_bodies", "missing_subjects", "empty_texts")


def _sections(found):
    """All sections of a report as one table."""
    figures = F.array(*[F.struct(F.lit(n).alias("item"), F.col(n).cast("bigint").alias("n")) for n in _WHOLE])
    means = F.array(*[
        F.struct(F.lit(n).alias("item"), F.floor(F.col(n) * 1000).cast("bigint").alias("n")) for n in ("avg_length", "avg_urls")
    ])
    parts = [
        found["daily"].select(F.lit("daily").alias("section"), day_of(F.col("day")).alias("item"), "n"),
        found["top_senders"].select(F.lit("top_senders"), "from", "n"),
        found["keywords"].select(F.lit("keywords"), "keyword", "n"),
        found["duplicates"].select(F.lit("duplicates"), F.lit(None).cast("string"), "duplicate_ids"),
        found["summary"].select(F.lit("total"), F.lit(None).cast("string"), "total"),
        found["summary"].select(F.lit("content"), F.inline(F.concat(figures, means))),
        found["sample"].select(F.lit("sample"), F.concat("id", F.lit(" "), "subject"), F.lit(1).cast("bigint")),
    ]
    return reduce(lambda a, b: a.unionAll(b), parts)


def quality_report(spark, sf):
    """All sections of the report over whole bodies."""
    return _sections(report_of(D.mail_records(spark, sf)))


def _profiled(spark, sf, counted=None):
    """A table loaded in three steps, each added to its profile, whose parts are merged once."""
    path = run_dir(spark, "mail")
    mail = D.mail_records(spark, sf)
    for n, part in enumerate((F.col("lang") == "de", F.col("lang") == "es", ~F.col("lang").isin("de", "es"))):
        tables.write_mail(mail.filter(part), path, mode="append")
        dayprofile.refresh(spark, path, counted)
        if n == 1:
            dayprofile.compact(spark, path)
    return path


def report_incremental(spark, sf):
    """The same report from the profile kept per day, brought up to date by every load."""
    return _sections(dayprofile.report(spark, _profiled(spark, sf)))


def profile_days(spark, sf):
    """The figures kept per day."""
    return dayprofile.days(spark, _profiled(spark, sf)).select(
        day_of(F.col("day")).alias("day"), text_of(F.col("earliest")).alias("earliest"),
        text_of(F.col("latest")).alias("latest"), "total", "lengths", "length_sum", "min_length", "max_length",
        "urls", "missing_bodies", "missing_subjects", "empty_texts",
    )


def profile_items(spark, sf):
    """Categories of cleaned texts by day and long words of subjects, counted as the table is loaded."""
    words = F.filter(F.split(F.lower("subject"), " "), lambda w: F.length(w) >= 8)
    path = _profiled(spark, sf, {
        "category": profile.categories(F.col("body.clean_text"), D.RULES), "theme": F.array_distinct(words),
    })
    by_day = dayprofile.counts(spark, path, "category", by_day=True)
    themes = dayprofile.counts(spark, path, "theme")
    return by_day.select(F.lit("category").alias("kind"), day_of(F.col("day")).alias("day"), "item", "n").unionByName(
        themes.select(F.lit("theme").alias("kind"), F.lit(None).cast("string").alias("day"), "item", "n")
    )


def keywords(spark, sf):
    return profile.top_keywords(D.table(spark, sf, "documents", heavy=True), column="text")


def subject_keywords(spark, sf):
    return profile.top_keywords(D.mail(spark, sf))


def null_audit(spark, sf):
    return profile.null_audit(D.mail_records(spark, sf))


def dup_ids(spark, sf):
    return profile.dup_ids(D.mail(spark, sf))


def dup_id_count(spark, sf):
    return profile.dup_id_count(D.mail(spark, sf))


def _categorised(spark, sf):
    mail = D.mail(spark, sf, heavy=True)
    return profile.with_category(mail, F.col("text"), D.RULES)


def category_daily(spark, sf):
    rows = profile.category_daily(_categorised(spark, sf))
    return rows.withColumn("day", day_of(F.col("day")))


def category_share(spark, sf):
    return _rounded(profile.category_share(_categorised(spark, sf)), "share")


def themes(spark, sf):
    words = F.filter(F.split(F.lower("text"), " "), lambda w: F.length(w) >= 8)
    return profile.top_themes(D.mail(spark, sf, heavy=True), F.array_distinct(words))


def sort_recent(spark, sf):
    ordering = [*order.recent_order(), F.col("pos").asc()]
    narrow = D.mail(spark, sf).select("parsed_ts", "id", "pos")
    return order.with_position(narrow, ordering).select(
        "position", "pos", "id", text_of(F.col("parsed_ts")).alias("parsed_ts")
    )


def sort_recent_plain(spark, sf):
    return order.sort_recent(D.mail(spark, sf).select("id", "pos", "parsed_ts")).select(
        "id", "pos", text_of(F.col("parsed_ts")).alias("parsed_ts")
    )


def top_k(spark, sf):
    counts = D.mail(spark, sf).groupBy("threadId").agg(F.count(F.lit(1)).alias("n"))
    return order.top_k(counts, 10, "n", F.col("threadId").asc()).withColumnRenamed("threadId", "thread")


def first_last(spark, sf):
    both = order.first_last(D.mail(spark, sf), "pos", "subject")
    pick = lambda side: [
        F.col(f"{side}.id").alias(f"{side}_id"), F.col(f"{side}.pos").alias(f"{side}_pos"),
        text_of(F.col(f"{side}.parsed_ts")).alias(f"{side}_ts"),
        F.col(f"{side}.subject").alias(f"{side}_subject"),
    ]
    return both.select(*pick("first"), *pick("last"))


def sample(spark, sf):
    return order.sample_subjects(D.mail(spark, sf))


def _polls(spark, sf):
    """One poll per day: how many events each of two stores has received by then."""
    per_day = D.table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("event_type").isin("click", "view")).alias("_a"),
        F.count_if(~F.col("event_type").isin("click", "view")).alias("_b"),
    )
    numbered = per_day.withColumn("seq", F.unix_date("day"))
    return sequence.prefix_scan(
        numbered, [], "seq", {"count_a": ("sum", "_a"), "count_b": ("sum", "_b")}
    ).select("seq", "day", "count_a", "count_b")


def progress(spark, sf):
    tracked = sequence.progress(_polls(spark, sf))
    return tracked.select(
        day_of(F.col("day")).alias("day"), "count_a", "count_b", "current", "new", "total_processed"
    )


def final_progress(spark, sf):
    return sequence.final_progress(sequence.progress(_polls(spark, sf)))


QUERIES = {
    f.__name__: f
    for f in (
        total, date_range, latest_date, freshness, top_senders, daily, content_stats,
        quality_summary, quality_report, report_incremental, profile_days, profile_items, keywords, subject_keywords, null_audit, dup_ids, dup_id_count,
        category_daily, category_share, themes, sort_recent, sort_recent_plain, top_k,
        first_last, sample, progress, final_progress,
    )
}

_SP = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NSP = _SP.replace("[", "[^", 1)


def body_sql(source: str, text: str, keep: str, urls: str = "urls", name: str = "bodies") -> str:
    """CTEs that clean ``text`` of ``source`` as the body functions do."""
    return rf"""{name}_u AS (
  SELECT {keep}, {text} AS t, list_transform(
    regexp_extract_all({text}, 'https?://[!$-_a-z]+'), lambda u: regexp_replace(u, '[.,;!?)]+$', '')) AS {urls}
  FROM {source}),
{name}_r AS (
  SELECT *, regexp_replace(list_reduce({urls}, lambda acc, u: replace(acc, u, ''), t), '{_SP}+', ' ', 'g') AS r FROM {name}_u),
{name}_e AS (
  SELECT *, regexp_replace(replace(replace(replace(r, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g') AS e FROM {name}_r),
{name} AS (
  SELECT *, trim(regexp_replace(regexp_replace(replace(replace(e, chr(8204), ''), chr(65279), ''),
    'http{_NSP}*|\[link\]|\[/link\]|\(link\)|\(/link\)', '', 'g'), '{_SP}+', ' ', 'g')) AS clean FROM {name}_e)"""


_BODIES = body_sql("mail", "content", "pos, id, ts, subject")
_STATS = """round(avg(length(clean)), 6) AS avg_length, CAST(min(length(clean)) AS BIGINT) AS min_length,
  CAST(max(length(clean)) AS BIGINT) AS max_length, CAST(sum(coalesce(len(urls), 0)) AS BIGINT) AS total_urls,
  round(avg(coalesce(len(urls), 0)), 6) AS avg_urls"""
# Words that are no keywords.
_STOP = "('the','a','an','and','or','but','in','on','at','to','for','of','with','by')"


def _keywords_sql(source: str, column: str) -> str:
    return rf"""words AS (SELECT unnest(string_split(regexp_replace(lower({column}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' ')) AS keyword FROM {source})
SELECT keyword, count(*) AS n FROM words WHERE length(keyword) > 2 AND keyword NOT IN {_STOP}
GROUP BY keyword ORDER BY n DESC, keyword LIMIT 10"""


_RULES_SQL = " UNION ALL ".join(
    f"SELECT pos, ts, '{name}' AS category FROM mail WHERE regexp_matches(text, '{rule}')"
    for name, rule in D.RULES
)
_POLLS = """days AS (
  SELECT CAST(ts AS DATE) AS d, count(*) FILTER (event_type IN ('click', 'view')) AS ca,
    count(*) FILTER (event_type NOT IN ('click', 'view')) AS cb FROM events GROUP BY 1),
polls AS (
  SELECT d, CAST(sum(ca) OVER (ORDER BY d) AS BIGINT) AS count_a, CAST(sum(cb) OVER (ORDER BY d) AS BIGINT) AS count_b FROM days),
cur AS (SELECT *, greatest(count_a, count_b) AS current FROM polls),
high AS (SELECT *, coalesce(max(current) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h FROM cur),
tracked AS (SELECT *, greatest(current - h, 0) AS new, h + greatest(current - h, 0) AS total_processed FROM high)"""

ORACLE = {
    "total": over_mail("SELECT count(*) AS total FROM mail"),
    "date_range": over_mail(
        f"SELECT {ts_sql('min(ts)')} AS earliest, {ts_sql('max(ts)')} AS latest FROM mail"
    ),
    "latest_date": over_mail(f"SELECT {ts_sql('max(ts)')} AS latest FROM mail"),
    "freshness": over_mail(
        "SELECT CAST(date_diff('second', max(ts), TIMESTAMP '2025-01-01 00:00:00') AS BIGINT) AS age_seconds FROM mail"
    ),
    "top_senders": over_mail(
        "SELECT sender, count(*) AS n FROM mail GROUP BY sender ORDER BY n DESC, sender NULLS FIRST LIMIT 5"
    ),
    "daily": over_mail(f"SELECT {day_sql('ts')} AS day, count(*) AS n FROM mail GROUP BY 1"),
    "content_stats": over_mail(f"SELECT {_STATS} FROM bodies", _BODIES),
    "quality_summary": over_mail(
        f"""SELECT count(*) AS total, {ts_sql('min(ts)')} AS earliest, {ts_sql('max(ts)')} AS latest, {_STATS},
  count(*) FILTER (ts IS NULL) AS missing_dates, count(*) FILTER (t IS NULL) AS missing_bodies,
  count(*) FILTER (subject IS NULL) AS missing_subjects, count(*) FILTER (clean = '') AS empty_texts FROM bodies""", _BODIES
    ),
    "quality_report": over_mail(
        f"""SELECT 'daily' AS section, {day_sql('ts')} AS item, count(*) AS n FROM mail GROUP BY 2
UNION ALL SELECT 'top_senders', sender, n FROM (
  SELECT sender, count(*) AS n FROM mail GROUP BY sender ORDER BY n DESC, sender NULLS FIRST LIMIT 5)
UNION ALL SELECT 'keywords', keyword, n FROM (WITH {_keywords_sql('mail', 'subject')})
UNION ALL SELECT 'duplicates', NULL, count(*) FROM (SELECT id FROM mail GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'total', NULL, count(*) FROM mail
UNION ALL SELECT 'content', unnest(['min_length', 'max_length', 'total_urls', 'missing_dates', 'missing_bodies',
    'missing_subjects', 'empty_texts', 'avg_length', 'avg_urls']),
  unnest([min(length(clean)), max(length(clean)), sum(coalesce(len(urls), 0)), count(*) FILTER (ts IS NULL),
    count(*) FILTER (t IS NULL), count(*) FILTER (subject IS NULL), count(*) FILTER (clean = ''),
    CAST(floor(avg(length(clean)) * 1000) AS BIGINT), CAST(floor(avg(coalesce(len(urls), 0)) * 1000) AS BIGINT)]) FROM bodies
UNION ALL SELECT 'sample', id || ' ' || subject, 1 FROM (
  SELECT id, coalesce(subject, 'No subject') AS subject FROM mail ORDER BY id, 2 LIMIT 5)""", _BODIES
    ),
    "keywords": "WITH " + _keywords_sql("documents", "text"),
    "subject_keywords": over_mail("", _keywords_sql("mail", "subject")),
    "null_audit": over_mail(
        """SELECT count(*) FILTER (ts IS NULL) AS missing_dates, count(*) FILTER (t IS NULL) AS missing_bodies,
  count(*) FILTER (subject IS NULL) AS missing_subjects, count(*) FILTER (clean = '') AS empty_texts FROM bodies""",
        _BODIES,
    ),
    "dup_ids": over_mail("SELECT id, count(*) AS n FROM mail GROUP BY id HAVING count(*) > 1"),
    "dup_id_count": over_mail(
        "SELECT count(*) AS duplicate_ids FROM (SELECT id FROM mail GROUP BY id HAVING count(*) > 1)"
    ),
    "category_daily": over_mail(
        f"SELECT {day_sql('ts')} AS day, category, count(*) AS n FROM c GROUP BY 1, 2",
        f"c AS ({_RULES_SQL})",
    ),
    "category_share": over_mail(
        "SELECT category, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM c GROUP BY category",
        f"c AS ({_RULES_SQL})",
    ),
    "themes": over_mail(
        """SELECT theme, count(*) AS n FROM (
  SELECT unnest(list_distinct(list_filter(string_split(lower(text), ' '), lambda w: length(w) >= 8))) AS theme FROM mail)
GROUP BY theme ORDER BY n DESC, theme LIMIT 10"""
    ),
    "sort_recent": over_mail(
        f"""SELECT row_number() OVER (ORDER BY ts DESC NULLS LAST, id, pos) AS position, pos, id,
  {ts_sql('ts')} AS parsed_ts FROM mail"""
    ),
    "sort_recent_plain": over_mail(f"SELECT id, pos, {ts_sql('ts')} AS parsed_ts FROM mail"),
    "top_k": over_mail(
        "SELECT thread, count(*) AS n FROM mail GROUP BY thread ORDER BY n DESC, thread LIMIT 10"
    ),
    "first_last": over_mail(
        f"""SELECT f.id AS first_id, f.pos AS first_pos, {ts_sql('f.ts')} AS first_ts, f.subject AS first_subject,
  l.id AS last_id, l.pos AS last_pos, {ts_sql('l.ts')} AS last_ts, l.subject AS last_subject
FROM (SELECT * FROM mail WHERE ts IS NOT NULL ORDER BY ts, id, pos LIMIT 1) f,
  (SELECT * FROM mail WHERE ts IS NOT NULL ORDER BY ts DESC, id DESC, pos DESC LIMIT 1) l"""
    ),
    "sample": over_mail(
        "SELECT id, coalesce(subject, 'No subject') AS subject FROM mail ORDER BY id, 2 LIMIT 5"
    ),
    "progress": f"WITH {_POLLS} SELECT {day_sql('d')} AS day, count_a, count_b, current, new, total_processed FROM tracked",
    "final_progress": f"""WITH {_POLLS} SELECT CAST(0 AS BIGINT) AS initial_count, max_by(count_a, d) AS final_count,
  max(total_processed) AS tracked, max_by(count_a, d) AS total_processed,
  max_by(count_a, d) <> max(total_processed) AS mismatch FROM tracked""",
}
# The same report, and the figures it is made of.
ORACLE["report_incremental"] = ORACLE["quality_report"]
ORACLE["profile_days"] = over_mail(
    f"""SELECT {day_sql('ts')} AS day, {ts_sql('min(ts)')} AS earliest, {ts_sql('max(ts)')} AS latest, count(*) AS total,
  count(clean) AS lengths, CAST(coalesce(sum(length(clean)), 0) AS BIGINT) AS length_sum,
  CAST(min(length(clean)) AS BIGINT) AS min_length, CAST(max(length(clean)) AS BIGINT) AS max_length,
  CAST(sum(coalesce(len(urls), 0)) AS BIGINT) AS urls, count(*) FILTER (t IS NULL) AS missing_bodies,
  count(*) FILTER (subject IS NULL) AS missing_subjects, count(*) FILTER (clean = '') AS empty_texts
FROM bodies GROUP BY 1""", _BODIES
)
_CLEAN_RULES = " UNION ALL ".join(
    f"SELECT ts, '{name}' AS category FROM bodies WHERE regexp_matches(clean, '{rule}')" for name, rule in D.RULES
)
ORACLE["profile_items"] = over_mail(
    f"""SELECT 'category' AS kind, {day_sql('ts')} AS day, category AS item, count(*) AS n FROM ({_CLEAN_RULES}) GROUP BY 2, 3
UNION ALL SELECT 'theme', NULL, word, count(*) FROM (
  SELECT unnest(list_distinct(list_filter(string_split(lower(subject), ' '), lambda w: length(w) >= 8))) AS word FROM mail)
GROUP BY word""", _BODIES
)
