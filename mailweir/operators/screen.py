"""Filters and predicates that decide what is kept."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweir.operators.combine import known_hits
from mailweir.operators.skew import skew_join
from mailweir.session import stage

#: Up to this many allowlist entries become a plain filter expression.
INLINE_ENTRIES = 64
#: Characters of the pieces that entries of a longer list are filed under.
PIECE = 6
#: Senders found, with what each takes, up to which they are broadcast.
BROADCAST_BYTES = 32 << 20


def as_instant(moment: dt.datetime | str) -> Column:
    """A literal instant; ISO text without an offset is read as UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def after_cutoff(ts: Column, cutoff: dt.datetime | str) -> Column:
    """Not older than the cutoff. A message without a date passes."""
    return ts.isNull() | (ts >= as_instant(cutoff))


def cutoff(df: DataFrame, moment: dt.datetime | str, ts: str = "parsed_ts") -> DataFrame:
    return df.filter(after_cutoff(F.col(ts), moment))


def sender_contains(sender: Column, entries: Sequence[str]) -> Column:
    """Whether any entry is a case-sensitive substring of the sender."""
    text = F.coalesce(sender, F.lit(""))
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(e)) for e in entries), F.lit(False))


def _pieces(text: Column, n: Column | int) -> Column:
    """All stretches of ``n`` characters; of a shorter text none."""
    n = F.lit(n) if isinstance(n, int) else n
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    cut = F.transform(starts, lambda i: F.substring(text, i, n))
    return F.when(F.length(text) >= n, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def filed_entries(allow: DataFrame, piece: int = PIECE) -> DataFrame:
    """``_piece, _entry``: every entry once, under the piece of it that fewest entries have.

    Entries shorter than a piece are filed under themselves. Rare pieces keep the entries
    apart that begin or end alike, such as the addresses of one domain.
    """
    entries = allow.select(F.col("sender").alias("_entry")).distinct()
    cut = entries.select("_entry", F.explode(_pieces(F.col("_entry"), piece)).alias("_piece"))
    held = cut.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    rarest = cut.join(held, "_piece").groupBy("_entry").agg(F.min(F.struct("_n", "_piece")).alias("_least"))
    short = entries.filter(F.length("_entry") < piece).select(F.col("_entry").alias("_piece"), "_entry")
    return rarest.select("_least._piece", "_entry").unionByName(short)


def matching_senders(df: DataFrame, allow: DataFrame, sender: str = "from", piece: int = PIECE) -> DataFrame:
    """Distinct senders that contain an entry, for lists of any length.

    An index by pieces of one length: each distinct sender is cut into its pieces, one per
    position, and meets the entries filed under them, by equality; of these candidates those
    count that it contains. No sender is compared with every entry, whatever lengths the
    entries have. Only entries shorter than a piece add pieces of their own few lengths.
    """
    of_lengths = F.collect_set(F.when(F.length("sender") < piece, F.length("sender"))).alias("short")
    # Fewer numbers than a piece has characters.
    lengths, missing_ones = allow.agg(of_lengths, F.count_if(F.col("sender").isNull())).first()
    if missing_ones:
        _strings([None])
    senders = df.select(F.coalesce(F.col(sender), F.lit("")).alias("_sender")).distinct()
    pieces = F.flatten(F.array(*[_pieces(F.col("_sender"), n) for n in [*sorted(lengths), piece]]))
    cut = senders.select("_sender", F.explode(pieces).alias("_piece")).alias("c")
    filed = stage(filed_entries(allow, piece), "filed-entries").alias("f")
    same = (F.col("c._piece") == F.col("f._piece")) & F.contains(F.col("c._sender"), F.col("f._entry"))
    return cut.join(filed, same, "left_semi").select("_sender").distinct()


def _join_senders(df: DataFrame, found: DataFrame, sender: str, how: str) -> DataFrame:
    """Join messages to the senders found; these are sent to every task as long as they are few,
    so that messages with their bodies stay where they are."""
    keyed = df.withColumn("_sender", F.coalesce(F.col(sender), F.lit("")))
    found = stage(found, "senders-found")
    few = found.agg(F.sum(F.length("_sender") + 32)).first()[0] or 0
    if few <= BROADCAST_BYTES:
        return keyed.join(F.broadcast(found), "_sender", how).drop("_sender")
    return skew_join(keyed, found, "_sender", how).drop("_sender")


def _strings(entries: list, kind: type = str) -> list:
    """The entries, none of which may be missing: it would match nothing and hide its fault."""
    if not all(isinstance(e, kind) for e in entries):
        raise ValueError("an allowlist entry must be a string")
    return entries


def _inline(allow: DataFrame | Sequence[str], limit: int) -> list[str] | None:
    if not isinstance(allow, DataFrame):
        entries = _strings(list(allow))
    else:
        entries = [r[0] for r in allow.select("sender").limit(limit + 1).collect()]
    return _strings(entries) if len(entries) <= limit else None


def _as_entries(df: DataFrame, allow: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(allow, DataFrame):
        return allow
    return df.sparkSession.createDataFrame([(e,) for e in allow], "sender string")


def with_sender_match(
    df: DataFrame, allow: DataFrame | Sequence[str], name: str = "_sender_ok",
    sender: str = "from", inline: int = INLINE_ENTRIES,
) -> DataFrame:
    """Add whether the sender matches the allowlist. A short list is an expression, a
    longer one a join with the matching distinct senders."""
    entries = _inline(allow, inline)
    if entries is not None:
        return df.withColumn(name, sender_contains(F.col(sender), entries))
    found = matching_senders(df, _as_entries(df, allow), sender).withColumn(name, F.lit(True))
    joined = _join_senders(df, found, sender, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def sender_allow(
    df: DataFrame, allow: DataFrame | Sequence[str], sender: str = "from",
    inline: int = INLINE_ENTRIES,
) -> DataFrame:
    """Keep messages whose sender contains an allowlist entry; an empty list keeps none."""
    entries = _inline(allow, inline)
    if entries is not None:
        return df.filter(sender_contains(F.col(sender), entries))
    found = matching_senders(df, _as_entries(df, allow), sender)
    return _join_senders(df, found, sender, "left_semi")


def label_filter(df: DataFrame, labels: Sequence[str], column: str = "labelIds") -> DataFrame:
    """Keep messages that carry any of the labels."""
    return df.filter(F.arrays_overlap(F.col(column), F.array(*[F.lit(x) for x in labels])))


def missing(column: str) -> Column:
    """Null or absent, which are the same thing here."""
    return F.col(column).isNull()


def outcome(
    scanned: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], moment: dt.datetime | str,
    allow: DataFrame | Sequence[str], pos: str = "pos", inline: int = INLINE_ENTRIES,
) -> DataFrame:
    """Label each scanned message: error, duplicate, cutoff, filtered or success.

    ``known`` are the stored ids, or a function that says which of the ids scanned are stored.

    A message is a duplicate if its id is stored already or was kept earlier in
    this scan. Ids are aggregated before anything is joined, and only ids that
    repeat take part, so copies of one message never gather in one task.
    """
    entries = _inline(allow, inline)
    if entries is not None:
        matched = with_sender_match(scanned, entries, inline=len(entries))
    else:
        # Matched by joins: done once, as the rows are looked at several times below.
        matched = stage(with_sender_match(scanned, allow, inline=0), "matched")
    flagged = matched.withColumn("_dated_ok", after_cutoff(F.col("parsed_ts"), moment))
    hits = known(flagged.filter("id is not null")) if callable(known) else known_hits(flagged, known)
    eligible = F.col("_dated_ok") & F.col("_sender_ok")
    repeats = (
        flagged.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(eligible, F.col(pos))).alias("_first"))
        .filter((F.col("_n") > 1) & F.col("_first").isNotNull())
    )
    marks = (
        hits.select("id", F.lit(True).alias("_known"), F.lit(None).cast(flagged.schema[pos].dataType).alias("_first"))
        .unionByName(repeats.select("id", F.lit(None).cast("boolean").alias("_known"), "_first"))
        .groupBy("id")
        .agg(F.max("_known").alias("_known"), F.min("_first").alias("_first"))
    )
    joined = skew_join(flagged, marks, "id", "left")
    label = (
        F.when(F.col("id").isNull(), "error")
        .when(F.col("_known") | (F.col(pos) > F.col("_first")), "duplicate")
        .when(~F.col("_dated_ok"), "cutoff")
        .when(~F.col("_sender_ok"), "filtered")
        .otherwise("success")
    )
    return joined.withColumn("outcome", label).drop(
        "_dated_ok", "_sender_ok", "_known", "_first"
    )
