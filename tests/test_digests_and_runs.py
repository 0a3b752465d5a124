"""Digests of stored ids, and runs with a window, a mirror and a status."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day, with_mail_date
from mailweir.operators import combine
from mailweir.operators.project import named_headers
from mailweir.plans import verify
from mailweir.plans.ingest import RunPaths, run_ingest
from mailweir.sources import idindex, load, raw, runlog, tables
from test_sources import CUTOFF, land, message, rows


def mail(spark, ids):
    data = [(str(i), str(i), dt.datetime(2024, 11, 1 + int(i) % 9)) for i in ids]
    return spark.createDataFrame(data, "id string, internalDate string, parsed_ts timestamp")


def indexed(spark, tmp_path, name, *parts):
    table = str(tmp_path / name)
    for part in parts:
        load.load_insert_only(mail(spark, part), table, index=True)
    return table


@pytest.mark.parametrize("b", [[range(200)], [range(100), range(50, 200)], [range(3, 260)], [range(1)]])
def test_stored_tables_are_reconciled_as_their_rows_are(spark, tmp_path, b):
    a, b = indexed(spark, tmp_path, "a", range(200)), indexed(spark, tmp_path, "b", *b)
    want = combine.reconcile(tables.read_mail(spark, a), tables.read_mail(spark, b))
    assert rows(verify.reconcile_stored(spark, a, b)) == rows(want)
    gate = verify.run_status(tables.read_mail(spark, a), tables.read_mail(spark, b))
    assert rows(verify.stored_status(spark, a, b)) == rows(gate)


def test_equal_stores_read_no_ids(spark, tmp_path):
    a = indexed(spark, tmp_path, "a", range(300))
    b = indexed(spark, tmp_path, "b", range(120), range(120, 300))
    assert idindex.differing(spark, a, b) == []
    found = verify.reconcile_stored(spark, a, b)
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    load.load_insert_only(mail(spark, [1000]), b)
    assert len(idindex.differing(spark, a, b)) == 1
    plan = verify.reconcile_stored(spark, a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "bucket" in plan


def test_sync_offers_what_is_lacking_only(spark, tmp_path):
    a, b = indexed(spark, tmp_path, "a", range(100)), indexed(spark, tmp_path, "b", range(50))
    stats, equal = load.sync(spark, a, b)
    assert (stats.total_processed, stats.successful, equal) == (50, 50, True)
    assert load.sync(spark, a, b)[0].total_processed == 0


@pytest.fixture
def landing(spark, tmp_path):
    dated = [message(f"d{n}", day=n) for n in range(10, 25)]
    undated = message("undated")
    undated["payload"]["headers"][1]["value"] = "sometime"
    land(tmp_path / "in", "1.json", [*dated, undated])
    read = with_mail_date(named_headers(raw.read_raw(spark, str(tmp_path / "in"))), "date")
    read = read.withColumn("pos", F.xxhash64("id")).withColumn("landed", utc_day("parsed_ts"))
    read.drop("from", "date", "subject", "parsed_ts", "parsed_iso", "tz_offset_min").write.partitionBy("landed").parquet(
        str(tmp_path / "days")
    )
    return spark.read.parquet(str(tmp_path / "days"))


def paths(tmp_path):
    return RunPaths(*[str(tmp_path / n) for n in ("mail", "snaps", "log", "stats")])


def test_a_run_reads_the_planned_days_and_undated_mail(spark, tmp_path, landing, monkeypatch):
    from mailweir.plans import ingest

    seen = []
    real = ingest.scan_outcomes

    def watched(scanned, *args, **options):
        seen.append(scanned)
        return real(scanned, *args, **options)

    monkeypatch.setattr(ingest, "scan_outcomes", watched)
    where = paths(tmp_path)
    for _ in range(2):
        run_ingest(spark, landing, where, CUTOFF, ["news@"], day="landed")
    stored = sorted(r["id"] for r in tables.read_mail(spark, where.table).collect())
    assert stored == sorted([f"d{n}" for n in range(14, 25)] + ["undated"])
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    assert all("PartitionFilters: [(isnull(landed" in p for p in plans)
    assert [df.count() for df in seen] == [12, 2]
    stats = {r["count_before"]: r for r in runlog.read_run_stats(spark, where.run_stats).collect()}
    assert (stats[0]["branch"], str(stats[0]["after_day"]), stats[0]["status"]) == ("initial", "2024-11-14", None)
    assert (stats[12]["branch"], str(stats[12]["after_day"])) == ("newer", "2024-11-24")


def test_the_gate_decides_on_a_runs_status(spark, tmp_path, landing):
    where, mirror = paths(tmp_path), str(tmp_path / "mirror")
    run_ingest(spark, landing, where, CUTOFF, ["news@"], mirror=mirror, run_id="one")
    load.load_insert_only(mail(spark, [77]), mirror)
    run_ingest(spark, landing, where, CUTOFF, ["news@"], mirror=mirror, run_id="two")
    status = {r["run_id"]: r["status"] for r in runlog.read_run_stats(spark, where.run_stats).collect()}
    assert status == {"one": "completed", "two": "completed_with_warnings"}
    assert tables.read_mail(spark, mirror).count() == 13
