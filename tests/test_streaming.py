"""The stream stores what the batch stores, whatever the batches, restarts and re-deliveries."""

import pytest

from mailweir.operators import combine
from mailweir.plans.ingest import screened_mail
from mailweir.sources import raw, tables
from mailweir.streaming.ingest import ingest_landed, read_stream, start_ingest
from mailweir.streaming.progress import progress_rows, write_progress
from test_sources import CUTOFF, land, message, rows


@pytest.fixture
def landing(tmp_path):
    for n in range(4):
        # Files overlap: each repeats the last messages of the one before.
        land(tmp_path / "in", f"f{n}.json", [message(f"m{i}") for i in range(n * 8, n * 8 + 10)])
    return tmp_path


def ingest(spark, tmp_path, files_per_batch, name="mail", **options):
    return ingest_landed(
        spark, str(tmp_path / "in"), str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"),
        CUTOFF, ["news@"], files_per_batch, **options,
    )


@pytest.mark.parametrize("files_per_batch", [1, 3, None])
def test_stream_equals_batch(spark, landing, files_per_batch):
    ingest(spark, landing, files_per_batch)
    stored = tables.read_mail(spark, str(landing / "mail"))
    batch = screened_mail(raw.read_raw(spark, str(landing / "in")), CUTOFF, ["news@"])
    want = combine.first_wins(batch, ["internalDate"])
    columns = ["id", "subject", "parsed_iso", "body"]
    assert rows(stored.select(*columns)) == rows(want.select(*columns))
    assert stored.count() == 34


def test_searching_only_the_days_touched_gives_the_same(spark, landing):
    ingest(spark, landing, 1, fixed_days=True)
    stored = tables.read_mail(spark, str(landing / "mail"))
    assert stored.count() == 34 == stored.select("id").distinct().count()


def test_restart_reads_only_what_is_new(spark, landing):
    ingest(spark, landing, 2)
    land(landing / "in", "g.json", [message("m1"), message("new")])
    query = ingest(spark, landing, 2)
    assert sum(r["input_rows"] for r in progress_rows(spark, query).collect()) == 2
    assert tables.read_mail(spark, str(landing / "mail")).count() == 35


def test_a_lost_checkpoint_adds_nothing(spark, landing):
    ingest(spark, landing, 2)
    stream = read_stream(spark, str(landing / "in"), files_per_batch=1)
    start_ingest(
        stream, lambda b: screened_mail(b, CUTOFF, ["news@"]), str(landing / "mail"),
        str(landing / "other-checkpoint"),
    ).awaitTermination()
    stored = tables.read_mail(spark, str(landing / "mail"))
    assert stored.count() == 34 == stored.select("id").distinct().count()


def test_a_failed_batch_is_repeated_without_harm(spark, landing):
    calls = []

    def failing(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stop here")
        return screened_mail(batch, CUTOFF, ["news@"])

    def start(records):
        stream = read_stream(spark, str(landing / "in"), files_per_batch=1)
        return start_ingest(stream, records, str(landing / "mail"), str(landing / "checkpoint"))

    with pytest.raises(Exception):
        start(failing).awaitTermination()
    assert 0 < tables.read_mail(spark, str(landing / "mail")).count() < 34
    start(lambda b: screened_mail(b, CUTOFF, ["news@"])).awaitTermination()
    assert tables.read_mail(spark, str(landing / "mail")).count() == 34


def test_progress_can_be_kept(spark, landing):
    query = ingest(spark, landing, 2)
    progress = progress_rows(spark, query)
    write_progress(progress, str(landing / "progress"))
    kept = spark.read.parquet(str(landing / "progress"))
    assert kept.count() == progress.count() >= 2
    assert kept.filter("time IS NULL").count() == 0
