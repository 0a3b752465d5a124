"""What a stream did, batch by batch, kept in a folder over restarts.

Two things are noted for a batch. Its outcomes, counted by the tasks that write its log, are noted
inside the batch, before its rows are stored, so no batch is without them. How long it
took is what Spark reports to a listener once the batch is over; if the driver ends in between,
that report is missing and its columns are NULL. Notes carry the query's id, which
its checkpoint keeps, so streams may share a folder.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from mailweir.sources.files import create, path_exists

OUTCOMES = ("success", "duplicate", "filtered", "cutoff", "error")
_NOTES = "query string, batch_id bigint, " + ", ".join(f"{o} bigint" for o in OUTCOMES)
_REPORTS = (
    "query string, batch_id bigint, run_id string, time string, input_rows bigint, "
    "rows_per_second double, batch_ms bigint"
)


class BatchReports(StreamingQueryListener):
    """Writes the reports of one query, which it tells from others by a name it makes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.name = f"mail-{uuid.uuid4().hex}"
        self._spark, self._folder, self._run = spark, folder.rstrip("/"), None
        self._ended = threading.Event()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        entry = json.loads(event.progress.json)
        if entry.get("name") != self.name:
            return
        row = {
            "query": entry["id"], "batch_id": entry["batchId"], "run_id": entry["runId"],
            "time": entry["timestamp"], "input_rows": entry["numInputRows"],
            "rows_per_second": float(entry.get("processedRowsPerSecond") or 0.0),
            "batch_ms": int((entry.get("durationMs") or {}).get("triggerExecution", 0)),
        }
        create(self._spark, f"{self._folder}/reports/{uuid.uuid4().hex}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._ended.set()

    def close(self, seconds: float = 60.0) -> bool:
        """Wait for the last report of a query that has ended; whether it came. A query that
        did not start has none.

        Spark hands events over in order, so the end comes after all reports.
        """
        came = self._run is not None and self._ended.wait(seconds)
        self._spark.streams.removeListener(self)
        return came


def outcome_figures(status: str = "status") -> list[Column]:
    """Counts of a batch's outcomes, to be observed or aggregated."""
    return [F.count_if(F.col(status) == o).alias(o) for o in OUTCOMES]


def note_outcomes(spark: SparkSession, folder: str, query: str, batch: int, figures: dict) -> None:
    """Note a batch's outcomes. The note of its first try stays."""
    row = {"query": query, "batch_id": batch, **{o: figures[o] for o in OUTCOMES}}
    create(spark, f"{folder.rstrip('/')}/outcomes/{query}-{batch}.json", json.dumps(row))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query and batch: its outcomes, and what Spark reported of the batch.

    Of several reports on a batch the one with most rows counts, as an idle query reports again.
    """
    notes = _read(spark, f"{folder.rstrip('/')}/outcomes", _NOTES)
    reports = _read(spark, f"{folder.rstrip('/')}/reports", _REPORTS).withColumn("time", F.col("time").cast("timestamp"))
    last = reports.groupBy("query", "batch_id").agg(
        F.max(F.struct("input_rows", "time", "run_id", "rows_per_second", "batch_ms")).alias("last")
    )
    return notes.join(last, ["query", "batch_id"], "left").select(*notes.columns, "last.*")
