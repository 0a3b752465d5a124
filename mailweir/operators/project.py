"""Projections: raw message to scanned message to mail record."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweir.functions.binding import compute_once
from mailweir.functions.dates import utc_day, with_mail_date
from mailweir.functions.text import decode_and_extract

# The part types that carry readable text.
TEXT_TYPES = ("text/plain", "text/html")


def first_header(headers: Column, name: str) -> Column:
    """Value of the first header with exactly this name; NULL if there is none."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def pick_body(payload: Column) -> Column:
    """Encoded data of the body to read; NULL if there is none.

    A message without parts carries its own data. Otherwise the first part that
    is text and not empty counts; parts inside parts are not searched.
    """
    own, parts = payload["body"]["data"], payload["parts"]
    texts = F.filter(
        parts, lambda p: p["mimeType"].isin(*TEXT_TYPES) & (F.length(p["body"]["data"]) > 0)
    )
    no_parts = F.coalesce(F.size(parts) <= 0, F.lit(True))
    return F.when(no_parts, F.when(F.length(own) > 0, own)).otherwise(
        F.get(texts, F.lit(0))["body"]["data"]
    )


def named_headers(raw: DataFrame) -> DataFrame:
    """Add sender, subject and the date as written."""
    headers = F.col("payload.headers")
    return compute_once(
        raw,
        {
            "from": first_header(headers, "From"),
            "date": first_header(headers, "Date"),
            "subject": first_header(headers, "Subject"),
        },
    )


def scan_headers(raw: DataFrame) -> DataFrame:
    """Add sender, subject and the parsed date: all that screening needs, no body work."""
    return with_mail_date(named_headers(raw), "date")


def to_mail(scanned: DataFrame, *extra: str) -> DataFrame:
    """Scanned messages to mail records; this is where bodies are decoded."""
    return scanned.select(
        "id", "threadId", "internalDate", "date", "parsed_ts", "tz_offset_min", "parsed_iso",
        "from", "subject",
        decode_and_extract(pick_body(F.col("payload"))).alias("body"),
        F.lit("success").alias("status"),
        "snippet", "labelIds",
        utc_day("parsed_ts").alias("mail_date"),
        *extra,
    )


def stamp_import(mail: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Record when rows entered the store."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return mail.withColumn("_imported_at", stamp)


def id_projection(mail: DataFrame) -> DataFrame:
    """Only the ids, so that a columnar scan reads one column."""
    return mail.select("id")


def metadata(mail: DataFrame) -> DataFrame:
    """The light view of a message used for comparison."""
    return mail.select("id", "parsed_ts", "from", "subject")
