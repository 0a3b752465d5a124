"""Readers and writers on small fixtures."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from mailweir.operators import combine
from mailweir.plans.ingest import RunPaths, run_ingest, screened_mail
from mailweir.sources import allowlist, load, raw, runlog, snapshots, tables

UTC = dt.timezone.utc
CUTOFF = dt.datetime(2024, 11, 14, tzinfo=UTC)


def message(ident, day=20, sender="News <news@a.example>", body="hello", **extra):
    data = base64.urlsafe_b64encode(body.encode()).decode()
    headers = [
        {"name": "From", "value": sender},
        {"name": "Date", "value": f"Wed, {day} Nov 2024 10:00:00 -0500"},
        {"name": "Subject", "value": f"subject {ident}"},
    ]
    return {"id": ident, "payload": {"headers": headers, "body": {"data": data}}, **extra}


def land(path, name, messages):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_raw_to_mail(spark, tmp_path):
    parts = [
        {"mimeType": "multipart/alternative", "parts": []},
        {"mimeType": "text/plain", "body": {}},
        {"mimeType": "text/plain"},
        {"mimeType": "text/html", "body": {"data": base64.b64encode(b"<p>Hi <b>you</b>").decode()}},
    ]
    multipart = message("m2")
    multipart["payload"]["parts"] = parts
    bare = {"id": "m3", "payload": {"headers": [{"name": "from", "value": "news@"}]}}
    land(tmp_path / "in", "a.json", [message("m1", labelIds=["A"], snippet="s"), multipart, bare])
    got = screened_mail(raw.read_raw(spark, str(tmp_path / "in")), CUTOFF, ["news@"])
    by_id = {r["id"]: r for r in got.collect()}
    assert set(by_id) == {"m1", "m2"}
    assert by_id["m1"]["body"].asDict() == {"clean_text": "hello", "urls": [], "length": 5}
    assert by_id["m1"]["parsed_iso"] == "2024-11-20T10:00:00-05:00"
    assert by_id["m1"]["labelIds"] == ["A"] and by_id["m2"]["labelIds"] is None
    assert by_id["m2"]["body"]["clean_text"] == "Hi you"


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    land(tmp_path / "in", "a.json", [message("m1"), "{not json", message("m2")])
    read = raw.read_raw(spark, str(tmp_path / "in"), rejects=True).cache()
    assert read.count() == 3
    assert rows(read.filter("_corrupt_record IS NOT NULL").select("_corrupt_record")) == [("{not json",)]


def record(ident, iso="2024-11-20T23:30:00-05:00", body=None):
    text = {"clean_text": "x, }\n    {\n y", "urls": ["http://a"], "length": 3}
    return {
        "id": ident, "threadId": "t", "internalDate": "1", "date": "d", "parsedDate": iso,
        "from": "a@b", "subject": "s\n    }", "body": text if body is None else body,
        "status": "success", "labelIds": ["L"],
    }


@pytest.mark.parametrize("count", [0, 1, 2, 25])
@pytest.mark.parametrize("layout", ["lines", "indented", "array"])
def test_json_layouts(spark, tmp_path, layout, count):
    records = [record(f"m{i}", *([None, ""] if i % 5 == 4 else [])) for i in range(count)]
    target = tmp_path / "mail.json"
    if layout == "lines":
        target.write_text("\n".join(json.dumps(r) for r in records))
    else:
        target.write_text(json.dumps(records, indent=4 if layout == "indented" else None, ensure_ascii=False))
    mail = tables.read_mail_json(spark, str(target), layout)
    got = {r["id"]: r for r in mail.collect()}
    assert len(got) == count == mail.count()
    for i in range(count):
        row = got[f"m{i}"]
        assert row["subject"] == "s\n    }" and row["labelIds"] == ["L"]
        if i % 5 == 4:
            assert row["body"] is None and row["parsed_ts"] is None and row["mail_date"] is None
        else:
            assert row["body"]["clean_text"] == "x, }\n    {\n y"
            assert row["tz_offset_min"] == -300 and str(row["mail_date"]) == "2024-11-21"


def test_missing_paths_are_empty_tables(spark, tmp_path):
    assert tables.read_mail(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_mail_json(spark, str(tmp_path / "none.json")).count() == 0
    assert runlog.read_run_log(spark, str(tmp_path / "none")).count() == 0
    assert snapshots.snapshots(spark, str(tmp_path / "none")) == []
    assert snapshots.snapshot(spark, str(tmp_path / "none"), str(tmp_path / "snaps")) is None


def test_json_export_round_trip(spark, tmp_path):
    source = tmp_path / "mail.json"
    source.write_text(json.dumps([record(f"m{i}") for i in range(9)], indent=4))
    mail = tables.read_mail_json(spark, str(source), "indented")
    tables.write_mail_json(mail, str(tmp_path / "out"))
    assert rows(tables.read_mail_json(spark, str(tmp_path / "out"))) == rows(mail)


@pytest.mark.parametrize("text", ["{", '{"a": 1}', '"news@"', "[1", ""])
def test_a_broken_allowlist_is_an_error(spark, tmp_path, text):
    (tmp_path / "allow.json").write_text(text)
    with pytest.raises(Exception):
        # An empty file has no row at all; reading one must not pass for an empty list.
        allowlist.read_allowlist(spark, str(tmp_path / "allow.json")).collect()


def test_a_missing_allowlist_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        allowlist.read_allowlist(spark, str(tmp_path / "none.json")).collect()


def test_allowlist(spark, tmp_path):
    (tmp_path / "allow.json").write_text('[\n  "a@",\n  "b"\n]\n')
    assert rows(allowlist.read_allowlist(spark, str(tmp_path / "allow.json"))) == [("a@",), ("b",)]
    (tmp_path / "empty.json").write_text("[]")
    assert allowlist.read_allowlist(spark, str(tmp_path / "empty.json")).count() == 0


def mail_rows(spark, ids, day="2024-11-20"):
    made = spark.createDataFrame([(i, n, day) for n, i in enumerate(ids)], "id string, pos int, d string")
    return made.select("id", "pos", F.col("d").cast("timestamp").alias("parsed_ts"))


def test_loading_twice_is_loading_once(spark, tmp_path):
    table = str(tmp_path / "mail")
    first = load.load_insert_only(mail_rows(spark, ["a", "b", "a", None]), table, ["pos"])
    assert first == load.LoadStats(total_processed=4, successful=2, duplicates=1, failed=1)
    again = load.load_insert_only(mail_rows(spark, ["a", "b", "a", None]), table, ["pos"])
    assert (again.successful, again.duplicates) == (0, 3)
    more = load.load_insert_only(mail_rows(spark, ["c", "b"]), table, ["pos"], fixed_days=True)
    assert (more.successful, more.duplicates) == (1, 1)
    undated = mail_rows(spark, ["d", "e"], None)
    assert load.load_insert_only(undated, table, ["pos"], fixed_days=True).successful == 2
    assert load.load_insert_only(undated, table, ["pos"], fixed_days=True).successful == 0
    stored = tables.read_mail(spark, table)
    assert rows(stored.select("id")) == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert combine.sets_equal(stored, stored).first()["equal"]
    assert stored.filter("_imported_at IS NULL").count() == 0


def test_days_prune_folders(spark, tmp_path):
    table = str(tmp_path / "mail")
    tables.write_mail(mail_rows(spark, ["a"], "2024-11-20").unionAll(mail_rows(spark, ["b"], "2024-11-21")), table)
    one_day = tables.read_mail(spark, table).filter("mail_date = '2024-11-20'")
    assert rows(one_day.select("id")) == [("a",)]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mail_date" in plan


def test_table_files_are_sorted_latest_first(spark, tmp_path):
    table = str(tmp_path / "mail")
    days = [f"2024-11-20 0{i}:00:00" for i in (3, 9, 1, 7)] + [None, None]
    made = spark.createDataFrame([(f"m{i}", d) for i, d in enumerate(days)], "id string, d string")
    tables.write_mail(made.select("id", F.col("d").cast("timestamp").alias("parsed_ts")), table)
    for file in (tmp_path / "mail").glob("mail_date=2024*/*.parquet"):
        stamps = [r[0] for r in spark.read.parquet(str(file)).select("parsed_ts").collect()]
        assert stamps == sorted(stamps, reverse=True)


def test_snapshots(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    at = dt.datetime(2025, 1, 1, tzinfo=UTC)
    tables.write_mail(mail_rows(spark, ["a"]), table)
    assert snapshots.snapshot(spark, table, root, at) == "20250101_000000"
    tables.write_mail(mail_rows(spark, ["b"]), table)
    snapshots.snapshot(spark, table, root, at + dt.timedelta(days=1))
    assert snapshots.snapshots(spark, root) == ["20250101_000000", "20250102_000000"]
    assert rows(snapshots.read_snapshot(spark, root).select("id")) == [("b",)]
    snapshots.restore(spark, root, table, "20250101_000000")
    assert rows(tables.read_mail(spark, table).select("id")) == [("a",)]
    hour = dt.timedelta(hours=1)
    assert snapshots.due(None, at, hour, False) and snapshots.due(at, at, hour, True)
    assert not snapshots.due(at, at + hour / 2, hour, False) and snapshots.due(at, at + hour, hour, False)


def run(spark, tmp_path, source, run_id, **options):
    paths = RunPaths(*(str(tmp_path / n) for n in ("mail", "snaps", "log", "stats")))
    numbered = raw.read_raw(spark, str(tmp_path / source)).withColumn(
        "pos", F.regexp_extract("id", "[0-9]+", 0).cast("int")
    )
    return paths, run_ingest(spark, numbered, paths, CUTOFF, ["news@"], run_id=run_id, **options)


def test_runs(spark, tmp_path):
    old = [message(f"m{i}", day=1) for i in (1, 2)]
    land(tmp_path / "one", "a.json", [*old, message("m3"), message("m4", sender="x"), message("m5")])
    paths, first = run(spark, tmp_path, "one", "r1")
    assert first == load.LoadStats(2, 2, 0, 0)
    land(tmp_path / "two", "a.json", [message("m5"), message("m6")])
    _, second = run(spark, tmp_path, "two", "r2")
    assert second.successful == 1
    stats = {r["run_id"]: r for r in runlog.read_run_stats(spark, paths.run_stats).collect()}
    assert (stats["r1"]["cutoff"], stats["r1"]["skipped"], stats["r1"]["direction"]) == (2, 1, "forward")
    assert (stats["r2"]["count_before"], stats["r2"]["count_new"], stats["r2"]["count_after"]) == (2, 1, 3)
    assert stats["r2"]["direction"] == "backward"
    log = runlog.read_run_log(spark, paths.run_log).filter("run_id = 'r1'")
    assert rows(log.select("message_id", "status")) == [
        ("m1", "cutoff"), ("m2", "cutoff"), ("m3", "success"), ("m4", "filtered"), ("m5", "success"),
    ]
    assert len(snapshots.snapshots(spark, paths.snapshots)) == 1


def test_copies_at_one_position_are_stored_once(spark, tmp_path):
    land(tmp_path / "one", "a.json", [message("m1"), message("m2"), message("m1")])
    paths, stats = run(spark, tmp_path, "one", "r1")
    assert (stats.successful, stats.duplicates) == (2, 1)
    assert rows(tables.read_mail(spark, paths.table).select("id")) == [("m1",), ("m2",)]


def test_a_run_can_stop_early(spark, tmp_path):
    days = [20, 1, 20, 1, 1, 20]
    land(tmp_path / "one", "a.json", [message(f"m{i}", day=d) for i, d in enumerate(days)])
    paths, stats = run(spark, tmp_path, "one", "r1", stop_after=2)
    assert stats.successful == 2
    assert rows(tables.read_mail(spark, paths.table).select("id")) == [("m0",), ("m2",)]
