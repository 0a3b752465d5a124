"""Mail dates: header text to an instant plus the offset it was written with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweir.functions.binding import compute_once
from mailweir.functions.patterns import SPACE_CHARS, SPACE_CLASS

# The zone names a header may use, and their offsets in minutes.
ZONES = {
    "UTC": 0,
    "GMT": 0,
    "EST": -300,
    "EDT": -240,
    "CST": -360,
    "CDT": -300,
    "PST": -480,
    "PDT": -420,
}
# English day and month abbreviations.
DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

_GAP = f"[{SPACE_CLASS}]+"
_LOCAL = (
    "(?:" + "|".join(DAYS) + ")," + _GAP
    + "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])" + _GAP
    + "(" + "|".join(MONTHS) + ")" + _GAP
    + "([0-9]{4})" + _GAP
    + "(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])"
)
# The zone is the last blank-separated word; blanks may follow it.
_HEADER = rf"(?i)\A{_LOCAL}{_GAP}([^{SPACE_CLASS}]+)[{SPACE_CLASS}]*\z"
# A zone that may be followed by nothing, as opposed to one that merely begins well.
_EXACT = r"\A([+-])([0-9]{2}):?([0-5][0-9])(?::?([0-5][0-9]))?\z"
_PREFIX = r"\A([+-]?)([0-9]{2})([0-9]{2})"

DAY_SECONDS = 86400


def _signed_seconds(text: Column, pattern: str, seconds: bool) -> Column:
    part = lambda n: F.regexp_extract(text, pattern, n)
    number = lambda n: F.coalesce(part(n).try_cast("int"), F.lit(0))
    total = number(2) * 3600 + number(3) * 60
    if seconds:
        total = total + number(4)
    return F.when(text.rlike(pattern), F.when(part(1) == "-", -total).otherwise(total))


def _offset_seconds(zone: Column, paren: Column) -> Column:
    zones = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    exact = F.when(zone == "Z", F.lit(0)).otherwise(_signed_seconds(zone, _EXACT, True))
    day = F.lit(DAY_SECONDS)
    named = F.coalesce(F.try_element_at(zones, zone), F.try_element_at(zones, paren)) * 60
    loose = F.coalesce(named, _signed_seconds(zone, _PREFIX, False))
    # An offset of a day or more is no offset: try the looser reading, then give up.
    return F.coalesce(F.when(F.abs(exact) < day, exact), F.when(F.abs(loose) < day, loose))


def with_mail_date(df: DataFrame, header: str = "date") -> DataFrame:
    """Read a Date header into ``parsed_ts``, ``tz_offset_min`` and ``parsed_iso``.

    All three are NULL if the header cannot be read. Day and month names ignore
    case; zone names do not. A comment in brackets supplies the zone name when
    the zone itself is neither a known name nor a plain numeric offset.

    The steps are separate projections because each result is used several
    times: one expression for all of it would repeat the patterns many times
    over and outgrow code generation.
    """
    col = F.col(header)
    commented = F.contains(col, F.lit("("))
    main = F.when(
        commented,
        F.btrim(F.split_part(col, F.lit("("), F.lit(1)), F.lit(SPACE_CHARS)),
    ).otherwise(col)
    comment = F.when(
        commented,
        F.btrim(F.split_part(col, F.lit("("), F.lit(2)), F.lit(" )")),
    )
    part = lambda n: F.get(F.col("_fields"), F.lit(n))
    whole = lambda n: F.trim(part(n)).try_cast("int")
    months = F.array(*[F.lit(m.lower()) for m in MONTHS])
    # One pass of the pattern; a header it does not fit yields no array.
    fields = F.when(
        F.col("_main").rlike(_HEADER),
        F.split(F.regexp_replace(F.col("_main"), _HEADER, "$1\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6\u0001$7"),
                "\u0001", -1),
    )
    year, month, day = F.col("_year"), F.col("_month"), F.col("_day")
    # Seconds since the epoch, so that no session time zone takes part.
    midnight = F.unix_seconds(
        F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    )
    clock = F.col("_hour") * 3600 + F.col("_minute") * 60 + F.col("_second")
    offset, local = F.col("_offset"), F.col("_local")
    ahead = F.abs(offset)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    zone_text = F.concat(
        F.when(offset < 0, "-").otherwise("+"),
        two(F.floor(ahead / 3600)), F.lit(":"), two(F.floor(ahead / 60) % 60),
        F.when(ahead % 60 > 0, F.concat(F.lit(":"), two(ahead % 60))).otherwise(""),
    )
    iso = F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), two(month), F.lit("-"), two(day),
        F.lit("T"), two(F.col("_hour")), F.lit(":"), two(F.col("_minute")), F.lit(":"),
        two(F.col("_second")), zone_text,
    )
    valid = offset.isNotNull() & local.isNotNull()
    names = df.columns
    steps = (
        df.select("*", main.alias("_main"), comment.alias("_comment"))
        .select(*names, "_comment", fields.alias("_fields"))
        .select(
            *names, "_comment",
            whole(0).alias("_day"),
            F.array_position(months, F.lower(part(1))).cast("int").alias("_month"),
            whole(2).alias("_year"),
            whole(3).alias("_hour"), whole(4).alias("_minute"), whole(5).alias("_second"),
            part(6).alias("_zone"),
        )
        .select(
            "*",
            _offset_seconds(F.col("_zone"), F.col("_comment")).alias("_offset"),
            F.when((month > 0) & (year >= 1), midnight + clock).alias("_local"),
        )
    )
    dated = compute_once(
        steps,
        {
            "parsed_ts": F.when(valid, F.timestamp_seconds(local - offset)),
            "tz_offset_min": F.when(valid, F.floor(offset / 60).cast("int")),
            "parsed_iso": F.when(valid, iso),
        },
    )
    return dated.select(*names, "parsed_ts", "tz_offset_min", "parsed_iso")


def iso_instant(iso: Column) -> Column:
    """ISO text with an offset to an instant; NULL if it is not one."""
    return iso.try_cast("timestamp")


def utc_day(ts: Column | str) -> Column:
    """The day of an instant in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def iso_to_day(iso: Column) -> Column:
    """The UTC day of ISO text with an offset."""
    return utc_day(iso_instant(iso))
