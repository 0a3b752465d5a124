"""The quality report over a mail table, and the comparison of two stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.text import code_points, size_or_zero
from mailweir.operators import combine, profile
from mailweir.operators.order import sample_subjects
from mailweir.sources import idindex
from mailweir.sources.tables import read_mail


def summary(mail: DataFrame) -> DataFrame:
    """Total, date range, content and missing-field figures from a single scan."""
    length, links = code_points(F.col("body.clean_text")), size_or_zero(F.col("body.urls"))
    return mail.agg(
        F.count(F.lit(1)).alias("total"),
        F.min("parsed_ts").alias("earliest"),
        F.max("parsed_ts").alias("latest"),
        F.avg(length).alias("avg_length"),
        F.min(length).cast("bigint").alias("min_length"),
        F.max(length).cast("bigint").alias("max_length"),
        F.coalesce(F.sum(links), F.lit(0)).cast("bigint").alias("total_urls"),
        F.avg(links).alias("avg_urls"),
        F.count_if(F.col("parsed_ts").isNull()).alias("missing_dates"),
        F.count_if(F.col("body").isNull()).alias("missing_bodies"),
        F.count_if(F.col("subject").isNull()).alias("missing_subjects"),
        F.count_if(F.col("body.clean_text") == "").alias("empty_texts"),
    )


def quality_report(mail: DataFrame) -> dict[str, DataFrame]:
    """All sections of the report, each a lazy DataFrame of a few rows or one per day."""
    return {
        "summary": summary(mail),
        "daily": profile.daily(mail),
        "top_senders": profile.top_senders(mail),
        "keywords": profile.top_keywords(mail),
        "sample": sample_subjects(mail),
        "duplicates": profile.dup_id_count(mail),
    }


def store_comparison(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """What two stores that should agree differ in."""
    return {
        "difference": combine.reconcile(a, b),
        "gate": combine.verify_gate(a, b),
        "range_a": profile.date_range(a),
        "range_b": profile.date_range(b),
        "top_senders": profile.top_senders(b),
    }


def _with_status(gate: DataFrame) -> DataFrame:
    return gate.withColumn("status", F.when(F.col("passed"), "completed").otherwise("completed_with_warnings"))


def run_status(a: DataFrame, b: DataFrame) -> DataFrame:
    """How a run ended: completed if both stores agree, otherwise with warnings."""
    return _with_status(combine.verify_gate(a, b))


def reconcile_stored(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``reconcile`` of two tables by their indexes, which are made where they are missing.

    Digests tell the buckets whose ids differ; the ids of these alone are read.
    """
    for table in (a, b):
        idindex.recover(spark, table) if idindex.exists(spark, table) else idindex.build(spark, table)
    buckets = idindex.differing(spark, a, b)
    return combine.reconcile(idindex.entries(spark, a, buckets), idindex.entries(spark, b, buckets))


def stored_status(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``run_status`` of two tables by their indexes: rows are counted, only ids that may differ read."""
    count_a, count_b = read_mail(spark, a).count(), read_mail(spark, b).count()
    differing = F.col("only_in_a") + F.col("only_in_b")
    return _with_status(
        reconcile_stored(spark, a, b).select(
            F.lit(count_a).alias("count_a"), F.lit(count_b).alias("count_b"), differing.alias("ids_differing"),
            (F.lit(count_a == count_b) & (differing == 0)).alias("passed"),
        )
    )
