"""Explicit schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()

HEADER = T.StructType([T.StructField("name", _S), T.StructField("value", _S)])
CONTENT = T.StructType([T.StructField("data", _S)])
PART = T.StructType([T.StructField("mimeType", _S), T.StructField("body", CONTENT)])

#: A message as the mail service returns it.
RAW = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("threadId", _S),
        T.StructField("internalDate", _S),
        T.StructField("snippet", _S),
        T.StructField("labelIds", T.ArrayType(_S)),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("mimeType", _S),
                    T.StructField("headers", T.ArrayType(HEADER)),
                    T.StructField("body", CONTENT),
                    T.StructField("parts", T.ArrayType(PART)),
                ]
            ),
        ),
    ]
)

BODY = T.StructType(
    [
        T.StructField("clean_text", _S),
        T.StructField("urls", T.ArrayType(_S)),
        T.StructField("length", T.IntegerType()),
    ]
)

#: A stored message. ``mail_date`` is the partition column of every mail table.
MAIL = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("threadId", _S),
        T.StructField("internalDate", _S),
        T.StructField("date", _S),
        T.StructField("parsed_ts", T.TimestampType()),
        T.StructField("tz_offset_min", T.IntegerType()),
        T.StructField("parsed_iso", _S),
        T.StructField("from", _S),
        T.StructField("subject", _S),
        T.StructField("body", BODY),
        T.StructField("status", _S),
        T.StructField("snippet", _S),
        T.StructField("labelIds", T.ArrayType(_S)),
        T.StructField("_imported_at", T.TimestampType()),
        T.StructField("mail_date", T.DateType()),
    ]
)

#: A stored message in the JSON interchange layout: dates are ISO strings there.
MAIL_JSON = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("threadId", _S),
        T.StructField("internalDate", _S),
        T.StructField("date", _S),
        T.StructField("parsedDate", _S),
        T.StructField("from", _S),
        T.StructField("subject", _S),
        # Either an object or, for a message without text, the empty string.
        T.StructField("body", _S),
        T.StructField("status", _S),
        T.StructField("snippet", _S),
        T.StructField("labelIds", T.ArrayType(_S)),
        T.StructField("_imported_at", _S),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", _S),
        T.StructField("time", T.TimestampType()),
        T.StructField("message_id", _S),
        T.StructField("status", _S),
        T.StructField("subject", _S),
        T.StructField("date", _S),
        T.StructField("error", _S),
    ]
)

RUN_STATS = T.StructType(
    [
        T.StructField("run_id", _S),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("cutoff_date", T.TimestampType()),
        T.StructField("existing_earliest", T.TimestampType()),
        T.StructField("existing_latest", T.TimestampType()),
        T.StructField("direction", _S),
        T.StructField("total_processed", _L),
        T.StructField("successful", _L),
        T.StructField("skipped", _L),
        T.StructField("cutoff", _L),
        T.StructField("errors", _L),
        T.StructField("count_before", _L),
        T.StructField("count_new", _L),
        T.StructField("count_after", _L),
        T.StructField("branch", _S),
        T.StructField("after_day", T.DateType()),
        T.StructField("before_day", T.DateType()),
        T.StructField("status", _S),
    ]
)
