"""Mail derived from the given tables, once as DataFrames and once as SQL.

Every row of the source table becomes one message. A message's id is a digest of
its text, so copies of a text are copies of a message, and everything else that
matters about it (date, subject, body) follows from the text as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.binding import compute_once
from mailweir.functions.text import structure_body
from mailweir.session import spread
from mailweir.sources.tables import conform

CUTOFF = "2024-11-14T00:00:00+00:00"
ALLOW = ("src1@", "src7@", "SRC9@", "@de.")
#: The zone a message's date is written in, by its length.
ZONES = (" +0000", " -0500 (EST)", " GMT", " EDT", " XYZ (PST)", " 0530", " MST", "")
RULES = (
    ("german", " (der|die|das|und) "),
    ("french", " (le|la|les|une) "),
    ("english", " (the|and|of) "),
    ("spanish", " (el|los|una|y) "),
    ("numbers", "[0-9]{4,}"),
)


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A given table; ``heavy`` announces costly work on each row."""
    # Days and dates in results are UTC ones.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if heavy else rows


def _local_ts() -> Column:
    minutes = (F.col("n_chars") * 37 % 86400).cast("int")
    return F.timestamp_seconds(F.lit(1730419200) + minutes * 60)


def _unless(remainder_of: int, value: Column) -> Column:
    return F.when(F.col("n_chars") % remainder_of != 0, value)


def _content() -> Column:
    link = F.concat(
        F.lit(" see https://"), F.col("source"), F.lit(".example/a/"), F.col("doc_id"),
        F.lit(", and (http://x.example/y)."),
    )
    tail = F.when(F.col("n_chars") % 3 == 0, link).otherwise("")
    return _unless(53, F.concat(F.col("text"), tail))


def _sender() -> Column:
    address = F.concat("source", F.lit(" <"), "source", F.lit("@"), "lang", F.lit(".example>"))
    return _unless(89, address)


def _subject() -> Column:
    return _unless(61, F.substring_index("text", "\n", 1))


def mail(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """One message per document; ``content`` is its text before cleaning."""
    return table(spark, sf_dir, "documents", heavy).select(
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("m"), F.md5("text")).alias("id"),
        F.concat_ws("-", F.lit("t"), "lang", "source").alias("threadId"),
        _sender().alias("from"),
        _subject().alias("subject"),
        _unless(97, _local_ts()).alias("parsed_ts"),
        F.array(F.upper("lang")).alias("labelIds"),
        "lang", "source", "text",
        _content().alias("content"),
    )


def mail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with cleaned bodies."""
    content = F.col("content")
    return mail(spark, sf_dir, heavy=True).withColumn(
        "body", F.when(content.isNotNull(), structure_body(content))
    )


def store_a(df: DataFrame) -> DataFrame:
    """The first store holds no Spanish mail."""
    return df.filter(F.col("lang") != "es")


def store_b(df: DataFrame) -> DataFrame:
    """The second store holds no German mail."""
    return df.filter(F.col("lang") != "de")


def stored(df: DataFrame) -> DataFrame:
    """In table layout, with the scan position kept."""
    return conform(df)


def _encoded(text: Column) -> Column:
    # Landed bodies are one line of URL-safe base64.
    line = F.replace(F.base64(text), F.lit("\r\n"), F.lit(""))
    return F.replace(F.replace(line, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))


def _headers(*pairs: tuple[str, Column]) -> Column:
    structs = [
        F.when(value.isNotNull(), F.struct(F.lit(name).alias("name"), value.alias("value")))
        for name, value in pairs
    ]
    return F.array_compact(F.array(*structs))


def _part(mime: str, data: Column) -> Column:
    return F.struct(
        F.lit(mime).alias("mimeType"), F.struct(data.cast("string").alias("data")).alias("body")
    )


def raw_documents(spark: SparkSession, sf_dir: str, bodies: bool = True) -> DataFrame:
    """Documents as raw messages: French ones have parts, the others carry their own body.

    Headers in the wrong case come first and repeats last; neither may be picked.
    For work on headers alone the bodies can be left out.
    """
    zone = F.get(F.array(*[F.lit(z) for z in ZONES]), (F.col("n_chars") % len(ZONES)).cast("int"))
    date = F.concat(F.date_format(_local_ts(), "EEE, d MMM yyyy HH:mm:ss"), zone)
    named = table(spark, sf_dir, "documents", heavy=bodies).withColumns(
        {"_sender": _sender(), "_subject": _subject(), "_date": _unless(97, date)}
    )
    if bodies:
        named = compute_once(named, {"_data": _encoded(_content())})
    else:
        named = named.withColumn("_data", F.lit(None).cast("string"))
    data, sender = F.col("_data"), F.col("_sender")
    multipart = F.col("lang") == "fr"
    no_parts = F.array().cast("array<struct<mimeType:string,body:struct<data:string>>>")
    parts = F.array(_part("text/calendar", F.lit("QUJD")), _part("text/plain", F.lit("")),
                    _part("text/plain", data), _part("text/html", F.lit("QUJD")))
    return named.select(
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("m"), F.md5("text")).alias("id"),
        F.concat_ws("-", F.lit("t"), "lang", "source").alias("threadId"),
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("internalDate"),
        F.col("source").alias("snippet"),
        F.array(F.upper("lang")).alias("labelIds"),
        F.struct(
            F.when(multipart, "multipart/mixed").otherwise("text/plain").alias("mimeType"),
            _headers(
                ("from", F.lit("wrong@case.example")), ("From", sender),
                ("Date", F.col("_date")), ("SUBJECT", F.lit("wrong case")),
                ("Subject", F.col("_subject")),
                ("From", F.when(sender.isNotNull(), F.lit("second@from.example"))),
            ).alias("headers"),
            F.struct(F.when(~multipart, data).alias("data")).alias("body"),
            F.when(multipart, parts).otherwise(no_parts).alias("parts"),
        ).alias("payload"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as raw HTML messages, undated, from the page's host."""
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    return table(spark, sf_dir, "pages", heavy=True).select(
        F.col("page_id").alias("pos"),
        F.concat(F.lit("p"), F.md5("html")).alias("id"),
        F.lit(None).cast("string").alias("threadId"),
        F.lit(None).cast("string").alias("internalDate"),
        F.lit(None).cast("string").alias("snippet"),
        F.lit(None).cast("array<string>").alias("labelIds"),
        F.struct(
            F.lit("multipart/alternative").alias("mimeType"),
            _headers(("From", host), ("Subject", F.col("url"))).alias("headers"),
            F.struct(F.lit(None).cast("string").alias("data")).alias("body"),
            F.array(_part("image/png", F.lit("QUJD")), _part("text/html", _encoded(F.col("html"))))
            .alias("parts"),
        ).alias("payload"),
    )


def text_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


# ---------------------------------------------------------------- the same in SQL

MAIL_SQL = r"""mail AS (
  SELECT doc_id AS pos, 'm' || md5(text) AS id, 't-' || lang || '-' || source AS thread,
    CASE WHEN n_chars % 89 <> 0 THEN source || ' <' || source || '@' || lang || '.example>' END AS sender,
    CASE WHEN n_chars % 61 <> 0 THEN split_part(text, chr(10), 1) END AS subject,
    TIMESTAMP '2024-11-01 00:00:00' + to_minutes(n_chars * 37 % 86400) AS local_ts,
    CASE WHEN n_chars % 97 <> 0 THEN TIMESTAMP '2024-11-01 00:00:00' + to_minutes(n_chars * 37 % 86400) END AS ts,
    lang, source, text, n_chars,
    CASE WHEN n_chars % 53 <> 0 THEN text || CASE WHEN n_chars % 3 = 0
      THEN ' see https://' || source || '.example/a/' || doc_id || ', and (http://x.example/y).' ELSE '' END END AS content
  FROM documents)"""

# A French message without a text has an alternative part, which then is its body.
READABLE_SQL = "coalesce(content, CASE WHEN lang = 'fr' THEN 'ABC' END)"

STORES_SQL = (
    "a AS (SELECT * FROM mail WHERE lang <> 'es'), b AS (SELECT * FROM mail WHERE lang <> 'de')"
)

_ZONE_CASE = "CASE n_chars % 8 " + " ".join(
    f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONES)
) + " END"
_NAMES = (
    "CASE {0} WHEN 'UTC' THEN 0 WHEN 'GMT' THEN 0 WHEN 'EST' THEN -300 WHEN 'EDT' THEN -240 "
    "WHEN 'CST' THEN -360 WHEN 'CDT' THEN -300 WHEN 'PST' THEN -480 WHEN 'PDT' THEN -420 END"
)
_DATE_RE = (
    r"^[A-Z][a-z]{{2}}, ([0-9]{{1,2}} [A-Z][a-z]{{2}} [0-9]{{4}} [0-9:]{{8}})"
    r"(?: ([^ (]+))?(?: \(([A-Z]+)\))?$"
).replace("{{", "{").replace("}}", "}")

SCANNED_SQL = rf"""header AS (
  SELECT *, CASE WHEN n_chars % 97 <> 0 THEN strftime(local_ts, '%a, %-d %b %Y %H:%M:%S') || {_ZONE_CASE} END AS header
  FROM mail),
fields AS (
  SELECT *, try_strptime(regexp_extract(header, '{_DATE_RE}', 1), '%d %b %Y %H:%M:%S') AS wall,
    regexp_extract(header, '{_DATE_RE}', 2) AS zone, regexp_extract(header, '{_DATE_RE}', 3) AS paren
  FROM header),
offsets AS (
  SELECT *, CASE
    WHEN regexp_matches(zone, '^[+-][0-9]{{4}}$') THEN (CASE WHEN zone[1] = '-' THEN -1 ELSE 1 END)
      * (CAST(zone[2:3] AS INT) * 60 + CAST(zone[4:5] AS INT))
    WHEN {_NAMES.format('zone')} IS NOT NULL THEN {_NAMES.format('zone')}
    WHEN {_NAMES.format('paren')} IS NOT NULL THEN {_NAMES.format('paren')}
    WHEN regexp_matches(zone, '^[0-9]{{4}}$') THEN CAST(zone[1:2] AS INT) * 60 + CAST(zone[3:4] AS INT)
    END AS off FROM fields),
scanned AS (
  SELECT * EXCLUDE (ts), wall - to_minutes(off) AS ts,
    CASE WHEN off IS NOT NULL AND wall IS NOT NULL THEN strftime(wall, '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN off < 0 THEN '-' ELSE '+' END
      || lpad(CAST(abs(off) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs(off) % 60 AS VARCHAR), 2, '0') END AS iso
  FROM offsets)"""

MATCH_SQL = "(" + " OR ".join(f"contains(coalesce(sender, ''), '{e}')" for e in ALLOW) + ")"
DATED_SQL = "(ts IS NULL OR ts >= TIMESTAMP '2024-11-14 00:00:00')"


def ts_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def over_mail(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((MAIL_SQL, *ctes)) + "\n" + select


def over_stores(select: str, *ctes: str) -> str:
    return over_mail(select, STORES_SQL, *ctes)


def over_scan(select: str, *ctes: str) -> str:
    return over_mail(select, SCANNED_SQL, *ctes)
