"""Progress of a streaming query as rows."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "run_id string, batch_id bigint, time timestamp, input_rows bigint, "
    "rows_per_second double, batch_ms bigint"
)


def keep_progress(kept: dict, queries: Iterable[StreamingQuery]) -> None:
    """Add what the queries remember to ``kept``, by run and batch; the last report of a batch counts."""
    for query in queries:
        for entry in query.recentProgress:
            entry = entry if isinstance(entry, dict) else json.loads(entry.json)
            before = kept.get((entry["runId"], entry["batchId"]))
            # A batch without data reports again and again while the query idles.
            if before is None or entry["numInputRows"] >= before["numInputRows"]:
                kept[entry["runId"], entry["batchId"]] = entry


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per batch of the query: those Spark remembers, and, for a query of
    ``start_ingest``, all that it has forgotten."""
    kept = dict(getattr(query, "kept_progress", {}))
    keep_progress(kept, [query])
    records = []
    for entry in kept.values():
        records.append(
            (
                entry["runId"], entry["batchId"], entry["timestamp"], entry["numInputRows"],
                float(entry.get("processedRowsPerSecond") or 0.0),
                int((entry.get("durationMs") or {}).get("triggerExecution", 0)),
            )
        )
    schema = PROGRESS.replace("time timestamp", "time string")
    rows = spark.createDataFrame(records, schema)
    return rows.withColumn("time", rows["time"].cast("timestamp"))


def write_progress(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
