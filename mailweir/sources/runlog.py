"""Run log (a row per scanned message) and run statistics (a row per run)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.schemas import RUN_LOG, RUN_STATS
from mailweir.sources.tables import path_exists


def log_rows(outcomes: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Outcomes as run-log rows. Subject and date are noted for kept messages only."""
    kept = F.col("outcome") == "success"
    error = F.when(F.col("outcome") == "error", "message without an id")
    return outcomes.select(
        F.lit(run_id).alias("run_id"),
        (F.current_timestamp() if at is None else at).alias("time"),
        F.col("id").alias("message_id"),
        F.col("outcome").alias("status"),
        F.when(kept, F.col("subject")).alias("subject"),
        F.when(kept, F.col("parsed_iso")).alias("date"),
        error.alias("error"),
    )


def write_run_log(rows: DataFrame, path: str) -> None:
    rows.select(*RUN_LOG.fieldNames()).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_LOG)
    return spark.read.schema(RUN_LOG).parquet(path)


def write_run_stats(rows: DataFrame, path: str) -> None:
    have = set(rows.columns)
    rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUN_STATS.fields
        ]
    ).write.mode("append").parquet(path)


def read_run_stats(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_STATS)
    return spark.read.schema(RUN_STATS).parquet(path)
