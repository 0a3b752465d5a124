"""Structured Streaming over landed messages."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from mailweir.registry import derive as D
from mailweir.registry.derive import over_mail, over_scan, text_of, ts_sql
from mailweir.registry.flows import RUNS_SQL
from mailweir.session import run_dir
from mailweir.sources.files import names
from mailweir.sources.raw import write_raw
from mailweir.sources.runlog import read_run_log
from mailweir.sources.tables import read_mail
from mailweir.streaming.ingest import ingest_landed, ingest_stateful, read_stream, start_ingest
from mailweir.streaming.metrics import batch_metrics
from mailweir.streaming.progress import progress_rows

#: Files the landed messages are split into at least, and how many of so few one batch admits.
FILES, FILES_PER_BATCH = 4, 2


def _land(df, path):
    """Land messages in as many files as the source has partitions."""
    write_raw(df, path)


def _land_for(spark, sf, path, batches):
    """Land all messages for a number of batches; how many files one batch has to admit for that.

    The tasks and files follow the source, as in ``_land``. Only where these are few does a task
    split its rows over several files: from ``batches * (batches - 1)`` files on, an equal
    share of them, rounded up, cuts any number into just so many batches.
    """
    least = max(FILES, batches * (batches - 1))
    rows = D.table(spark, sf, "documents").count()
    write_raw(D.raw_documents(spark, sf), path, max(1, rows // least))
    return max(1, math.ceil(len(names(spark, path, "part-")) / batches))


def stream_ingest(spark, sf):
    """Land, ingest, land the same again, ingest: the second delivery adds nothing."""
    root = run_dir(spark, "stream")
    raw = D.raw_documents(spark, sf)
    for _ in range(2):
        _land(raw, f"{root}/landing")
        ingest_landed(
            spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
            files_per_batch=FILES_PER_BATCH,
        )
    return read_mail(spark, f"{root}/mail").select(
        "id", "subject", text_of(F.col("parsed_ts")).alias("ts"), "parsed_iso"
    )


def stream_resume(spark, sf):
    """Two deliveries of different mail with a stop in between: each row is read once."""
    root = run_dir(spark, "stream")
    raw = D.raw_documents(spark, sf)
    batches = []
    for part in (raw.filter(F.array_contains("labelIds", "EN")), raw.filter(~F.array_contains("labelIds", "EN"))):
        _land(part, f"{root}/landing")
        query = ingest_landed(
            spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
            files_per_batch=FILES_PER_BATCH,
        )
        batches.append(progress_rows(spark, query))
    seen = batches[0].unionAll(batches[1])
    return seen.agg(F.sum("input_rows").alias("input_rows"))


def stream_batches(spark, sf):
    """How the admission limit cuts one delivery into batches, from the query's own progress."""
    root = run_dir(spark, "stream")
    files_per_batch = _land_for(spark, sf, f"{root}/landing", FILES // FILES_PER_BATCH)
    query = ingest_landed(
        spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
        files_per_batch=files_per_batch,
    )
    filled = progress_rows(spark, query).filter("input_rows > 0")
    return filled.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows")
    )


def stream_progress(spark, sf):
    """Progress of more batches than Spark remembers."""
    root, limit = run_dir(spark, "stream"), "spark.sql.streaming.numRecentProgressUpdates"
    files_per_batch = _land_for(spark, sf, f"{root}/landing", 2 * FILES)
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        query = ingest_landed(
            spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
            files_per_batch=files_per_batch,
        )
    finally:
        spark.conf.set(limit, before)
    filled = progress_rows(spark, query).filter("input_rows > 0")
    return filled.agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"))


def stream_restart(spark, sf):
    """Half of the mail by one query, the other half by one with a fresh checkpoint and the same log."""
    root = run_dir(spark, "stream")
    raw = D.raw_documents(spark, sf)
    for name, part in (("one", F.col("pos") % 2 == 0), ("two", F.col("pos") % 2 == 1)):
        _land(raw.filter(part), f"{root}/{name}")
        ingest_landed(
            spark, f"{root}/{name}", f"{root}/mail", f"{root}/{name}-checkpoint", D.CUTOFF, D.ALLOW,
            log=f"{root}/log", rejects=f"{root}/rejects",
        )
    return read_mail(spark, f"{root}/mail").select(
        "id", "subject", text_of(F.col("parsed_ts")).alias("ts"), "parsed_iso"
    )


def stream_state(spark, sf):
    """As ``stream_ingest``, with the ids stored so far in the stream's state."""
    root = run_dir(spark, "stream")
    raw = D.raw_documents(spark, sf)
    for _ in range(2):
        _land(raw, f"{root}/landing")
        ingest_stateful(spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW)
    return read_mail(spark, f"{root}/mail").select(
        "id", "subject", text_of(F.col("parsed_ts")).alias("ts"), "parsed_iso"
    )


def stream_table(spark, sf):
    """A given table itself as the stream."""
    root = run_dir(spark, "stream")
    schema = D.table(spark, sf, "documents").schema
    stream = read_stream(
        spark, f"{sf}/documents*.parquet", schema, fmt="parquet", files_per_batch=1
    )

    def to_records(batch):
        return batch.select(
            F.col("doc_id").alias("pos"), F.concat(F.lit("m"), F.md5("text")).alias("id"),
            F.col("text").alias("subject"), F.lit(None).cast("timestamp").alias("parsed_ts"),
        )

    start_ingest(stream, to_records, f"{root}/mail", f"{root}/checkpoint", ["pos"]).awaitTermination()
    return read_mail(spark, f"{root}/mail").select("id", F.length("subject").cast("bigint").alias("length"))


def stream_log(spark, sf):
    """What became of every message of two equal deliveries, by the stream's own log."""
    root = run_dir(spark, "stream")
    for _ in range(2):
        _land(D.raw_documents(spark, sf), f"{root}/landing")
        ingest_landed(
            spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
            files_per_batch=None, log=f"{root}/log",
        )
    rows = read_run_log(spark, f"{root}/log")
    return rows.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


def stream_metrics(spark, sf):
    """What every batch of two equal deliveries did, by the figures kept over the restart."""
    root = run_dir(spark, "stream")
    for _ in range(2):
        _land(D.raw_documents(spark, sf), f"{root}/landing")
        ingest_landed(
            spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
            files_per_batch=None, metrics=f"{root}/metrics",
        )
    return batch_metrics(spark, f"{root}/metrics").select(
        "batch_id", "input_rows", "success", "duplicate", "filtered", "cutoff", "error"
    )


def stream_rejects(spark, sf):
    """Lines that are no message, landed among messages, are set aside with their text."""
    root = run_dir(spark, "stream")
    _land(D.raw_documents(spark, sf), f"{root}/landing")
    broken = D.table(spark, sf, "documents").select(F.concat(F.lit("{broken "), F.col("doc_id")).alias("value"))
    broken.write.mode("append").text(f"{root}/landing")
    ingest_landed(
        spark, f"{root}/landing", f"{root}/mail", f"{root}/checkpoint", D.CUTOFF, D.ALLOW,
        rejects=f"{root}/rejects",
    )
    return spark.read.parquet(f"{root}/rejects").select("line", "reason")


QUERIES = {f.__name__: f for f in (
    stream_ingest, stream_restart, stream_state, stream_resume, stream_batches, stream_progress, stream_table, stream_log,
    stream_metrics, stream_rejects,
)}

_STORED = over_scan(
    f"""SELECT id, any_value(subject) AS subject, {ts_sql('any_value(ts)')} AS ts, any_value(iso) AS parsed_iso
FROM scanned WHERE {D.DATED_SQL} AND {D.MATCH_SQL} GROUP BY id"""
)

ORACLE = {
    "stream_ingest": _STORED,
    "stream_restart": _STORED,
    "stream_state": _STORED,
    "stream_resume": "SELECT count(*) AS input_rows FROM documents",
    "stream_batches": f"SELECT CAST({FILES // FILES_PER_BATCH} AS BIGINT) AS batches, count(*) AS input_rows FROM documents",
    "stream_progress": f"SELECT CAST({2 * FILES} AS BIGINT) AS batches, count(*) AS input_rows FROM documents",
    "stream_log": over_scan(
        """SELECT 'batch-0' AS run_id, outcome AS status, count(*) AS n FROM run1 GROUP BY outcome
UNION ALL SELECT 'batch-1', outcome, count(*) FROM run2 GROUP BY outcome""", RUNS_SQL
    ),
    "stream_metrics": over_scan(
        " UNION ALL ".join(
            f"SELECT CAST({n} AS BIGINT) AS batch_id, count(*) AS input_rows, " + ", ".join(
                f"count(*) FILTER (outcome = '{o}') AS {o}" for o in ("success", "duplicate", "filtered", "cutoff", "error")
            ) + f" FROM run{n + 1}" for n in (0, 1)
        ), RUNS_SQL
    ),
    "stream_rejects": "SELECT '{broken ' || doc_id AS line, 'no JSON object' AS reason FROM documents",
    "stream_table": over_mail("SELECT id, any_value(n_chars) AS length FROM mail GROUP BY id"),
}
