"""The stream decides on headers, logs every message, and sets aside what is none."""

import json

import pytest
from pyspark.sql import functions as F

from mailweir.sources.runlog import read_run_log
from mailweir.sources.tables import read_mail, write_mail
from mailweir.streaming.ingest import ingest_landed, ingest_stateful
from test_sources import land, message

CUTOFF = "2024-11-14T00:00:00+00:00"


def ingest(spark, tmp_path, **options):
    paths = [str(tmp_path / n) for n in ("landing", "mail", "checkpoint")]
    return ingest_landed(spark, *paths, CUTOFF, ["news@"], log=str(tmp_path / "log"), **options)


def logged(spark, tmp_path):
    rows = read_run_log(spark, str(tmp_path / "log")).select("run_id", "message_id", "status").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_every_message_is_logged_and_a_second_delivery_stores_nothing(spark, tmp_path):
    landed = [message("a"), message("a"), message("b", sender="x"), message("c", day=1)]
    land(tmp_path / "landing", "1.json", landed)
    ingest(spark, tmp_path)
    land(tmp_path / "landing", "2.json", landed)
    ingest(spark, tmp_path)
    first = [("batch-0", i, s) for i, s in (("a", "duplicate"), ("a", "success"), ("b", "filtered"), ("c", "cutoff"))]
    second = [("batch-1", i, s) for i, s in (("a", "duplicate"), ("a", "duplicate"), ("b", "filtered"), ("c", "cutoff"))]
    assert logged(spark, tmp_path) == first + second
    assert [r["id"] for r in read_mail(spark, str(tmp_path / "mail")).collect()] == ["a"]


def test_a_repeated_batch_keeps_its_log_and_stores_what_is_missing(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [message("a"), message("b")])
    ingest(spark, tmp_path)
    before = logged(spark, tmp_path)
    # As after a failure before the batch was committed: the stream reads it again.
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        commit.unlink()
    table = str(tmp_path / "mail")
    write_mail(read_mail(spark, table).filter("id = 'a'"), table)
    ingest(spark, tmp_path)
    assert logged(spark, tmp_path) == before
    assert sorted(r["id"] for r in read_mail(spark, table).collect()) == ["a", "b"]


def test_a_fresh_checkpoint_beside_an_old_log_stores_everything(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [message(f"a{n}") for n in range(3)])
    ingest(spark, tmp_path, rejects=str(tmp_path / "rejects"))
    (tmp_path / "checkpoint").rename(tmp_path / "gone")
    land(tmp_path / "landing", "2.json", [message(f"b{n}") for n in range(5)])
    ingest(spark, tmp_path, rejects=str(tmp_path / "rejects"))
    assert read_mail(spark, str(tmp_path / "mail")).count() == 8
    rows = logged(spark, tmp_path)
    assert len(rows) == 11 and sum(s == "success" for _, _, s in rows) == 8
    assert len({run for run, _, _ in rows}) == 2 and "batch-0" in {run for run, _, _ in rows}


def test_streams_that_share_a_log_store_everything(spark, tmp_path):
    for name in ("one", "two"):
        land(tmp_path / name, "1.json", [message(f"{name}{n}") for n in range(4)] + ["{half " + name])
        ingest_landed(
            spark, str(tmp_path / name), str(tmp_path / f"{name}-mail"), str(tmp_path / f"{name}-checkpoint"), CUTOFF,
            ["news@"], log=str(tmp_path / "log"), rejects=str(tmp_path / "rejects"),
        )
    for name in ("one", "two"):
        assert read_mail(spark, str(tmp_path / f"{name}-mail")).count() == 4
    assert len(logged(spark, tmp_path)) == 10
    lines = {r["line"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert lines == {"{half one", "{half two"}


def test_a_log_of_before_queries_were_named_is_left_alone(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [message("a")])
    ingest(spark, tmp_path)
    for mark in (tmp_path / "log").glob("*_query*"):
        mark.unlink()
    (tmp_path / "checkpoint").rename(tmp_path / "gone")
    land(tmp_path / "landing", "2.json", [message("b")])
    ingest(spark, tmp_path)
    assert read_mail(spark, str(tmp_path / "mail")).count() == 2


# ---- ids in the stream's state ----------------------------------------------------------

def stateful(spark, tmp_path, **options):
    paths = [str(tmp_path / n) for n in ("landing", "mail", "checkpoint")]
    return ingest_stateful(spark, *paths, CUTOFF, ["news@"], **options)


def test_state_keeps_ids_over_batches_and_restarts(spark, tmp_path):
    for n in range(3):
        land(tmp_path / "landing", f"{n}.json", [message(f"m{i}") for i in range(4 * n, 4 * n + 6)] + [message("x", sender="y")])
    stateful(spark, tmp_path, files_per_batch=1)
    assert sorted(r["id"] for r in read_mail(spark, str(tmp_path / "mail")).collect()) == sorted(f"m{i}" for i in range(14))
    land(tmp_path / "landing", "again.json", [message("m3"), message("new"), message("new"), message("old", day=1)])
    query = stateful(spark, tmp_path)
    stored = [r["id"] for r in read_mail(spark, str(tmp_path / "mail")).collect()]
    assert len(stored) == 15 and "new" in stored
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 15 and any("rocksdb" in k for k in state["customMetrics"])


def test_a_stateful_batch_does_not_read_the_table(spark, tmp_path, monkeypatch):
    from mailweir.streaming import ingest as module

    land(tmp_path / "landing", "1.json", [message("a")])
    stateful(spark, tmp_path)
    land(tmp_path / "landing", "2.json", [message("a"), message("b")])

    def refuse(*_):
        raise AssertionError("the table is read")

    monkeypatch.setattr(module, "read_mail", refuse)
    monkeypatch.setattr(module, "load_insert_only", refuse)
    query = stateful(spark, tmp_path)
    assert query.exception() is None
    assert str(tmp_path / "mail") not in query._jsq.explainInternal(True) if hasattr(query._jsq, "explainInternal") else True
    assert read_mail(spark, str(tmp_path / "mail")).count() == 2


def test_a_stateful_batch_repeated_after_a_failure_adds_nothing(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [message("a"), message("b")])
    stateful(spark, tmp_path)
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        commit.unlink()
    stateful(spark, tmp_path)
    assert sorted(r["id"] for r in read_mail(spark, str(tmp_path / "mail")).collect()) == ["a", "b"]


def test_a_new_state_beside_stored_mail_is_refused(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [message("a")])
    ingest(spark, tmp_path)
    (tmp_path / "checkpoint").rename(tmp_path / "gone")
    with pytest.raises(ValueError):
        stateful(spark, tmp_path)


def test_rejects_keep_their_text(spark, tmp_path):
    nameless = message("x")
    del nameless["id"]
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "1.json").write_text("\n".join([json.dumps(message("a")), "{half", json.dumps(nameless)]))
    ingest(spark, tmp_path, rejects=str(tmp_path / "rejects"))
    found = {r["reason"]: r["line"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert found["no JSON object"] == "{half" and set(found) == {"no JSON object", "message without an id"}
    kept = json.loads(found["message without an id"])
    assert kept["payload"]["headers"] == nameless["payload"]["headers"]
    assert read_mail(spark, str(tmp_path / "mail")).filter(F.col("id") == "a").count() == 1
