"""Ordered logic that must not put one long sequence into one task.

All sequences are laid out in order by one range partitioning on key and position. What falls
into a partition of it is a segment: rows that follow each other by rank, however far apart
their positions are. Work inside a segment is a window over it; what crosses segments is one
summary row per segment and key, an element of an associative operation, and a key has as
many of them as there are partitions at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailweir.operators.skew import skew_join
from mailweir.session import stage

_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def in_segments(df: DataFrame, key: str, pos: str, chunk: int | None = None) -> DataFrame:
    """The rows with ``_seg``, the number of their segment; numbers ascend with key and position.

    A segment is a partition of the session's shuffles, so it shrinks as these grow in number;
    ``chunk`` asks for that many rows a segment instead, for which they are counted first.
    """
    if chunk is None:
        laid = df.repartitionByRange(key, pos)
    else:
        laid = df.repartitionByRange(max(1, -(-df.count() // chunk)), key, pos)
    return laid.withColumn("_seg", F.spark_partition_id())


def prefix_scan(
    df: DataFrame, keys: Sequence[str], pos: str,
    outputs: Mapping[str, tuple[str, str]], chunk: int | None = None, inclusive: bool = True,
) -> DataFrame:
    """Running sum, max or min along ``pos`` (ordered, unique per key).

    ``outputs`` maps a new column to ``(kind, column)``. With ``inclusive`` false
    the current row is left out.
    """
    # The keys travel as one struct, which unlike its fields is never NULL: plain
    # equality then matches NULL keys and reuses the partitioning of the window.
    key = F.struct(*keys) if keys else F.struct(F.lit(0))
    # Written with its segments: rows and summaries have to be of the same layout.
    laid = stage(in_segments(df.withColumn("_key", key), "_key", pos, chunk), "segments")
    inside = Window.partitionBy("_key", "_seg").orderBy(pos).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    before = Window.partitionBy("_key").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy("_key", "_seg").agg(
        *[_COMBINE[kind](col).alias(f"_t_{out}") for out, (kind, col) in outputs.items()]
    )
    carried = totals.select(
        "_key", "_seg",
        *[_COMBINE[kind](f"_t_{out}").over(before).alias(f"_c_{out}") for out, (kind, _) in outputs.items()],
    )
    local = laid.withColumns(
        {f"_l_{out}": _COMBINE[kind](col).over(inside) for out, (kind, col) in outputs.items()}
    )

    def combined(out: str, kind: str):
        here, carry = F.col(f"_l_{out}"), F.col(f"_c_{out}")
        if kind == "sum":
            return F.when(
                here.isNotNull() | carry.isNotNull(),
                F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)),
            )
        return F.greatest(here, carry) if kind == "max" else F.least(here, carry)

    return local.join(carried, ["_key", "_seg"]).select(
        *df.columns,
        *[combined(out, kind).alias(out) for out, (kind, _) in outputs.items()],
    )


def early_stop(
    scan: DataFrame, mailbox: str = "mailbox", pos: str = "pos", outcome: str = "outcome",
    limit: int = 5, chunk: int | None = None,
) -> DataFrame:
    """Where each mailbox's scan stops: at the ``limit``-th old message with none kept between.

    Messages that are neither kept nor too old do not count either way. A mailbox
    that never stops has no row.

    In a segment, the old messages before its first kept one may continue a run
    from earlier segments; of these the first ``limit`` positions are remembered.
    Every later run is complete on its own.
    """
    relevant = scan.filter(F.col(outcome).isin("cutoff", "success")).select(
        F.col(mailbox).alias("_box"), F.col(pos).alias("_pos"),
        (F.col(outcome) == "success").cast("int").alias("_kept"),
    )
    in_segment = Window.partitionBy("_box", "_seg").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, 0
    )
    runs = in_segments(relevant, "_box", "_pos", chunk).withColumn("_run", F.sum("_kept").over(in_segment))
    # Old messages since the run began: those so far, less those before its kept message.
    olds = F.sum(1 - F.col("_kept")).over(in_segment)
    begun = F.max(F.when(F.col("_kept") == 1, F.col("_olds"))).over(in_segment)
    counted = runs.withColumn("_olds", olds).withColumn("_old", F.col("_olds") - F.coalesce(begun, F.lit(0)))
    old = F.col("_kept") == 0
    first_run = F.col("_run") == 0
    segments = counted.groupBy("_box", "_seg").agg(
        F.max("_kept").alias("_has_kept"),
        # Old messages after the last kept one: the count in the run that comes last.
        F.max(F.struct("_run", "_old")).getField("_old").alias("_tail"),
        F.min(F.when(old & ~first_run & (F.col("_old") == limit), F.col("_pos"))).alias("_later"),
        *[
            F.min(F.when(old & first_run & (F.col("_old") == n), F.col("_pos"))).alias(f"_lead_{n}")
            for n in range(1, limit + 1)
        ],
    )
    # What comes into a segment: the old messages in the tails before it, less those before
    # the tail of the last segment that holds a kept one.
    earlier = Window.partitionBy("_box").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    tailed = segments.withColumn("_before", F.coalesce(F.sum("_tail").over(earlier), F.lit(0)))
    start = F.max(F.when(F.col("_has_kept") == 1, F.col("_before"))).over(earlier)
    carried = tailed.withColumn("_carry", F.col("_before") - F.coalesce(start, F.lit(0)))
    # The run stops in this segment's lead at its (limit - carry)-th old message. A carry of
    # the limit or more means an earlier segment has stopped already.
    lead_stop = F.coalesce(
        *[F.when(F.col("_carry") == limit - n, F.col(f"_lead_{n}")) for n in range(1, limit + 1)]
    )
    return (
        carried.groupBy("_box")
        .agg(F.min(F.least(lead_stop, F.col("_later"))).alias("stop_pos"))
        .filter(F.col("stop_pos").isNotNull())
        .select(F.col("_box").alias(mailbox), "stop_pos")
    )


def until_stop(
    scan: DataFrame, stops: DataFrame, mailbox: str = "mailbox", pos: str = "pos"
) -> DataFrame:
    """The messages a scan sees before it stops; all of them for a mailbox that does not."""
    joined = skew_join(scan, stops, mailbox, "left")
    return joined.filter(
        F.col("stop_pos").isNull() | (F.col(pos) <= F.col("stop_pos"))
    ).drop("stop_pos")


def progress(
    polls: DataFrame, seq: str = "seq", count_a: str = "count_a", count_b: str = "count_b",
    initial: int = 0, run: Sequence[str] = (), chunk: int | None = None,
) -> DataFrame:
    """Per poll: the larger count, how many are new since the highest seen, and the total so far."""
    current = polls.withColumn(
        "current", F.greatest(F.coalesce(F.col(count_a), F.lit(0)), F.coalesce(F.col(count_b), F.lit(0)))
    )
    scanned = prefix_scan(current, run, seq, {"_high": ("max", "current")}, chunk, inclusive=False)
    high = F.greatest(F.coalesce(F.col("_high"), F.lit(initial)), F.lit(initial))
    fresh = F.greatest(F.col("current") - high, F.lit(0))
    return scanned.withColumn("new", fresh).withColumn(
        "total_processed", high + fresh - initial
    ).drop("_high")


def final_progress(
    tracked: DataFrame, count: str = "count_a", seq: str = "seq", initial: int = 0,
    run: Sequence[str] = (),
) -> DataFrame:
    """At the end the store's own count decides: tracked total, actual total, and whether they differ."""
    last = tracked.groupBy(*run).agg(
        F.max(F.struct(seq, count)).getField(count).alias("final_count"),
        F.max("total_processed").alias("tracked"),
    )
    actual = F.col("final_count") - initial
    return last.select(
        *run, F.lit(initial).cast("bigint").alias("initial_count"), "final_count", "tracked",
        actual.alias("total_processed"), (actual != F.col("tracked")).alias("mismatch"),
    )
