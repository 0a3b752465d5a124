"""Which part of the source an incremental run has to look at."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day
from mailweir.operators.profile import date_range, direction
from mailweir.operators.screen import as_instant

#: An increment after the latest stored message starts this much later.
GAP = dt.timedelta(hours=2)


def plan_increment(
    mail: DataFrame, cutoff: dt.datetime | str, mode: str = "forward"
) -> DataFrame:
    """One row: the branch taken, the days to ask for, and the direction of the run.

    ``forward`` looks from the latest stored message on. ``reference`` looks
    between cutoff and latest while the cutoff lies before the latest message,
    so new mail is only asked for once the cutoff has passed it.
    """
    if mode not in ("forward", "reference"):
        raise ValueError(f"unknown mode: {mode}")
    at = as_instant(cutoff)
    latest = F.col("latest")
    day = lambda c: utc_day(c)
    newer = latest + F.lit(GAP) if mode == "reference" else latest
    historical = F.lit(mode == "reference") & (at < latest)
    return date_range(mail).select(
        F.when(latest.isNull(), "initial").when(historical, "historical").otherwise("newer")
        .alias("branch"),
        F.when(latest.isNull() | historical, day(at)).otherwise(day(newer)).alias("after_day"),
        F.when(latest.isNotNull() & historical, day(latest)).alias("before_day"),
        direction(at, F.col("earliest")).alias("direction"),
        "earliest", "latest",
    )


def apply_increment(
    source: DataFrame, after_day: dt.date | None, before_day: dt.date | None = None,
    column: str = "mail_date",
) -> DataFrame:
    """Restrict a source to the planned days; on a table partitioned by day this prunes.

    A message without a date belongs to no day and is always looked at.
    """
    day = F.col(column)
    inside = F.lit(True)
    if after_day is not None:
        inside = inside & (day >= F.lit(after_day))
    if before_day is not None:
        inside = inside & (day < F.lit(before_day))
    return source.filter(day.isNull() | inside)
