"""Incremental ingest with Structured Streaming.

The stream's checkpoint records which files have been read, so a restart goes on
where the last run ended. The insert-only load makes a batch that is repeated
after a failure add nothing. Together a message is stored once, for good.

A batch is repeated if this very query has noted it before: notes carry the query's id, which
its checkpoint keeps over restarts. Notes of another query, as a fresh checkpoint makes one,
are left alone.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mailweir.functions.dates import utc_day, with_mail_date
from mailweir.operators.combine import first_wins
from mailweir.operators.project import named_headers, scan_headers, stamp_import, to_mail
from mailweir.operators.screen import cutoff, outcome, sender_allow
from mailweir.plans.ingest import screened_mail
from mailweir.schemas import RAW
from mailweir.session import stage
from mailweir.sources.files import create, read_text
from mailweir.sources.load import load_insert_only, stored_ids
from mailweir.sources.raw import CORRUPT
from mailweir.sources.runlog import log_rows
from mailweir.sources.tables import DAY, path_exists, read_mail, settle, write_mail
from mailweir.streaming.metrics import BatchReports, note_outcomes, outcome_figures
from mailweir.streaming.progress import keep_progress

#: Stands for the arrival of a message that does not say when it arrived: after all others.
LAST = (1 << 63) - 1


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType = RAW, fmt: str = "json",
    files_per_batch: int | None = 70, **options: str,
) -> DataFrame:
    """Landed files as a stream; ``files_per_batch`` bounds what one batch admits."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _start(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, continuous: str | None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each batch to ``load``, and keep the progress of all of them."""
    kept: dict = {}
    running: list[StreamingQuery] = []

    def take(batch: DataFrame, number: int) -> None:
        # Spark forgets the progress of early batches; each batch keeps that of those before it.
        keep_progress(kept, running)
        # The load looks at its input several times. The batch is bounded by the
        # admission limit and spills to disk; a lost block is read again from source.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            load(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    query.kept_progress = kept
    running.append(query)
    return query


def start_ingest(
    stream: DataFrame, to_records: Callable[[DataFrame], DataFrame], table: str, checkpoint: str,
    order: Sequence[str | Column] | None = None, continuous: str | None = None,
    fixed_days: bool = False,
) -> StreamingQuery:
    """Load a stream into a mail table.

    ``to_records`` turns one batch of the source into mail records. By default
    everything that has landed is loaded and the query ends; ``continuous`` gives
    a trigger interval for one that keeps running. Each batch looks its ids up in
    the whole table; ``fixed_days`` states that copies of a message agree on its
    date, and narrows that to the days the batch touches.
    """

    def load(batch: DataFrame, _: int) -> None:
        load_insert_only(to_records(batch), table, order, fixed_days)

    return _start(stream, load, checkpoint, continuous)


def _arrival(raw: DataFrame) -> Column:
    """The order copies of a message are taken in: arrival as a number, then the whole record."""
    arrived = F.coalesce(F.col("internalDate").try_cast("bigint"), F.lit(LAST))
    return F.struct(arrived.alias("arrived"), F.xxhash64(*RAW.fieldNames()).alias("digest"))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps over restarts, from its checkpoint."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def _owned(spark: SparkSession, folder: str, query: str) -> str:
    """What names of a query's batches begin with in a folder: nothing if it was there first.

    The first query to come names itself in a file that only one can create. A folder with
    batches but without that file is some earlier query's.
    """
    owner = f"{folder.rstrip('/')}/_query"
    if not path_exists(spark, folder):
        create(spark, owner, query)
    return "" if read_text(spark, owner) == query else f"{query}-"


def _write_outcomes(
    batch: DataFrame, table: str, moment: dt.datetime | str, allow: DataFrame | Sequence[str],
    fixed_days: bool, path: str,
) -> dict:
    """The outcome of every message of a batch, from its headers; how many there are of each,
    counted by the tasks that write them."""
    spark = batch.sparkSession
    place = F.struct("pos.arrived", "pos.digest", F.monotonically_increasing_id().alias("row"))
    scanned = stage(
        scan_headers(batch).select(
            "id", place.alias("pos"), "from", "subject", "parsed_ts", "parsed_iso"
        ),
        "scan",
    )

    def stored(ids: DataFrame) -> DataFrame:
        return stored_ids(spark, table, ids.withColumn(DAY, utc_day("parsed_ts")), fixed_days)

    outcomes = outcome(scanned, stored, moment, allow)
    counted = Observation()
    rows = log_rows(outcomes, "").drop("run_id").observe(counted, *outcome_figures())
    rows.write.mode("overwrite").parquet(path)
    return counted.get


def _set_rejects_aside(batch: DataFrame, path: str) -> None:
    """Write lines that are no message, and messages without an id, which cannot be stored."""
    broken = F.col(CORRUPT).isNotNull()
    batch.filter(F.col("id").isNull()).select(
        F.when(broken, F.col(CORRUPT)).otherwise(F.to_json(F.struct(*RAW.fieldNames()))).alias("line"),
        F.when(broken, "no JSON object").otherwise("message without an id").alias("reason"),
    ).write.mode("overwrite").parquet(path)


def ingest_landed(
    spark: SparkSession, landing: str, table: str, checkpoint: str,
    moment: dt.datetime | str, allow: DataFrame | Sequence[str], files_per_batch: int | None = 70,
    fixed_days: bool = False, log: str | None = None, rejects: str | None = None,
    metrics: str | None = None,
) -> StreamingQuery:
    """Screen, decode and load every raw message that has landed since the last call.

    Headers decide what becomes of a message: of a batch, only the bodies of messages that
    will be stored are decoded, so a second delivery decodes none. ``log`` is a folder for the
    outcomes, in the layout of the run log with one ``run_id`` a batch, and ``rejects`` one for
    lines that are no message. Queries may share both: batches of all but the first one carry
    their query's id. ``metrics`` is a folder for the figures of each batch, which
    ``batch_metrics`` reads.
    """
    settle(spark, table)
    # Named after the checkpoint, so that a restart finds what a failed try has written.
    outcomes = log or f"{checkpoint.rstrip('/')}-log"
    schema, options = RAW, {}
    if rejects:
        schema = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"columnNameOfCorruptRecord": CORRUPT}
    stream = read_stream(spark, landing, schema, files_per_batch=files_per_batch, **options)

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = query_id(session, checkpoint)
        if rejects:
            _set_rejects_aside(batch, f"{rejects}/batch={_owned(session, rejects, query)}{number}")
        placed = batch.withColumn("pos", _arrival(batch))
        path = f"{outcomes}/run_id={_owned(session, outcomes, query)}batch-{number}"
        # A batch that is repeated after a failure keeps the outcomes of its first try: some of
        # its messages may be stored by now, which the load then finds out.
        repeated = path_exists(session, f"{path}/_SUCCESS")
        figures = None if repeated else _write_outcomes(placed, table, moment, allow, fixed_days, path)
        logged = session.read.parquet(path)
        if metrics:
            figures = figures or logged.agg(*outcome_figures()).first().asDict()
            note_outcomes(session, metrics, query, number, figures)
        ids = logged.filter("status = 'success'").select(F.col("message_id").alias("id"))
        wanted = placed.join(ids, "id", "left_semi")
        records = first_wins(screened_mail(wanted, moment, allow, "pos"), ["pos"])
        if repeated:
            load_insert_only(records, table, ["pos"], fixed_days)
        else:
            write_mail(stamp_import(records), table, mode="append", ids=ids.distinct())

    reports = BatchReports(spark, metrics) if metrics else None
    try:
        query = _start(stream, load, checkpoint, None, reports.name if reports else None)
        query.awaitTermination()
    finally:
        if reports:
            reports.close()
    return query


#: The state store that keeps ids on executors' disks instead of in their memory.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ingest_stateful(
    spark: SparkSession, landing: str, table: str, checkpoint: str, moment: dt.datetime | str,
    allow: Sequence[str], files_per_batch: int | None = 70,
) -> StreamingQuery:
    """As ``ingest_landed``, with the ids stored so far in the stream's own state.

    Messages are screened by their headers, and of those of one id only the first passes, for
    ever: Spark keeps the ids, hashed over its state stores, so a batch neither reads the table
    nor grows with it. Of copies in one batch any one is taken. The state knows what this stream
    has let pass, so the table has to be its alone; a stream that begins with a table which
    already holds mail is refused. A batch that is repeated is looked up in the table.
    """
    settle(spark, table)
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/metadata") and not read_mail(spark, table).isEmpty():
        raise ValueError(f"{table} holds mail that a new stream's state does not know")
    stream = read_stream(spark, landing, files_per_batch=files_per_batch)
    screened = cutoff(with_mail_date(sender_allow(named_headers(stream), allow, inline=len(allow)), "date"), moment)
    first = screened.filter(F.col("id").isNotNull()).dropDuplicates(["id"])

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        mark = f"{checkpoint.rstrip('/')}-batches/{query_id(session, checkpoint)}-{number}"
        if create(session, mark):
            write_mail(stamp_import(to_mail(batch)), table, mode="append")
        else:
            load_insert_only(to_mail(batch), table)

    before = {k: spark.conf.get(k, None) for k in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        query = _start(first, load, checkpoint, None)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    return query
