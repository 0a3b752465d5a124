"""Aggregations that describe a mail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day
from mailweir.functions.text import code_points, is_keyword, long_words, size_or_zero
from mailweir.operators.combine import known_hits
from mailweir.operators.order import top_k


def total(mail: DataFrame) -> DataFrame:
    return mail.agg(F.count(F.lit(1)).alias("total"))


def date_range(mail: DataFrame) -> DataFrame:
    """Earliest and latest instant; messages without a date do not take part."""
    return mail.agg(F.min("parsed_ts").alias("earliest"), F.max("parsed_ts").alias("latest"))


def latest_date(mail: DataFrame) -> DataFrame:
    return mail.agg(F.max("parsed_ts").alias("latest"))


def freshness(mail: DataFrame, as_of: Column) -> DataFrame:
    """Seconds from the latest message to ``as_of``."""
    latest = F.max("parsed_ts")
    return mail.agg((F.unix_seconds(as_of) - F.unix_seconds(latest)).alias("age_seconds"))


def sender_counts(mail: DataFrame) -> DataFrame:
    return mail.groupBy("from").agg(F.count(F.lit(1)).alias("n"))


def top_senders(mail: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent senders; equal counts in sender order, no sender first."""
    return top_k(sender_counts(mail), k, "n", F.col("from").asc_nulls_first())


def daily(mail: DataFrame) -> DataFrame:
    """Messages per UTC day; those without a date form a group of their own."""
    return (
        mail.groupBy(utc_day("parsed_ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("day").asc_nulls_first())
    )


def content_stats(mail: DataFrame) -> DataFrame:
    """Text length in code points and link counts, over one scan."""
    length, links = code_points(F.col("body.clean_text")), size_or_zero(F.col("body.urls"))
    return mail.agg(
        F.avg(length).alias("avg_length"),
        F.min(length).cast("bigint").alias("min_length"),
        F.max(length).cast("bigint").alias("max_length"),
        F.coalesce(F.sum(links), F.lit(0)).cast("bigint").alias("total_urls"),
        F.avg(links).alias("avg_urls"),
    )


def keyword_counts(mail: DataFrame, column: str = "subject") -> DataFrame:
    words = mail.select(F.explode(long_words(F.col(column))).alias("keyword"))
    # Stop words are dropped as rows, inside generated code, not one by one in a lambda.
    return words.filter(is_keyword(F.col("keyword"))).groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


def top_keywords(mail: DataFrame, k: int = 10, column: str = "subject") -> DataFrame:
    return top_k(keyword_counts(mail, column), k, "n", F.col("keyword").asc())


def null_audit(mail: DataFrame) -> DataFrame:
    """Missing dates, bodies and subjects, and bodies that hold no text."""
    return mail.agg(
        F.count_if(F.col("parsed_ts").isNull()).alias("missing_dates"),
        F.count_if(F.col("body").isNull()).alias("missing_bodies"),
        F.count_if(F.col("subject").isNull()).alias("missing_subjects"),
        F.count_if(F.col("body.clean_text") == "").alias("empty_texts"),
    )


def dup_ids(mail: DataFrame, key: str = "id") -> DataFrame:
    """Ids that occur more than once."""
    return mail.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dup_id_count(mail: DataFrame, key: str = "id") -> DataFrame:
    return dup_ids(mail, key).agg(F.count(F.lit(1)).alias("duplicate_ids"))


def load_stats(incoming: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """What an insert-only load of ``incoming`` would report.

    Works on id counts, so repeats of one id never meet in one task. Rows without
    an id cannot be stored and have failed.
    """
    counted = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = known_hits(incoming, stored, key).withColumn("_known", F.lit(1))
    per_id = counted.join(known, key, "left")
    valid, new = F.col(key).isNotNull(), F.col("_known").isNull()
    sum_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_processed"),
        F.count_if(valid & new).alias("successful"),
        sum_if(~valid).alias("failed"),
        (sum_if(valid) - F.count_if(valid & new)).alias("duplicates"),
    )


def outcome_counts(outcomes: DataFrame, *keys: str) -> DataFrame:
    return outcomes.groupBy(*keys, "outcome").agg(F.count(F.lit(1)).alias("n"))


def run_stats(outcomes: DataFrame) -> DataFrame:
    """One row of counts by outcome; ``skipped`` is what was neither kept nor too old nor wrong."""
    of = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return outcomes.agg(
        of("success").alias("total_processed"), of("success").alias("successful"),
        of("duplicate", "filtered").alias("skipped"), of("cutoff").alias("cutoff"),
        of("error").alias("errors"),
    )


def direction(cutoff: Column, earliest: Column) -> Column:
    """Whether a run extends the collection into the past."""
    return F.when(earliest.isNotNull() & (cutoff < earliest), "backward").otherwise("forward")


def merge_info(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Counts before the merge, offered, added and after.

    Both sides are aggregated by id first; see ``load_stats`` for why. Repeats
    inside ``new`` all count, as they all survive the merge.
    """
    side = lambda df, a, b: df.select(
        "id", F.lit(a).alias("_old"), F.lit(b).alias("_new")
    )
    per_id = (
        side(existing, 1, 0).unionAll(side(new, 0, 1)).groupBy("id")
        .agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    )
    fresh = F.when(F.col("id").isNull() | (F.col("_old") == 0), F.col("_new")).otherwise(F.lit(0))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_id.agg(
        count(F.col("_old")).alias("pre_merge_count"),
        count(F.col("_new")).alias("offered_count"),
        count(fresh).alias("new_count"),
        (count(F.col("_old")) + count(fresh)).alias("post_merge_count"),
    )


def categories(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The categories whose pattern occurs in the text, each once."""
    hits = [F.when(text.rlike(pattern), F.lit(name)) for name, pattern in rules]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def with_category(
    mail: DataFrame, text: Column, rules: Sequence[tuple[str, str]]
) -> DataFrame:
    """One row per message and category. The rules are the caller's."""
    return mail.withColumn("category", F.explode(categories(text, rules)))


def category_daily(categorised: DataFrame) -> DataFrame:
    return (
        categorised.groupBy(utc_day("parsed_ts").alias("day"), "category")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("day").asc_nulls_first(), "category")
    )


def category_share(categorised: DataFrame) -> DataFrame:
    """Count and share per category. The window is over one row per category."""
    counts = categorised.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def top_themes(mail: DataFrame, themes: Column, k: int = 10) -> DataFrame:
    """The ``k`` most common entries of an array of themes."""
    counts = (
        mail.select(F.explode(themes).alias("theme")).groupBy("theme")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_k(counts, k, "n", F.col("theme").asc())
