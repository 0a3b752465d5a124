"""Figures of a stream's batches: complete over restarts and a lost report."""

import pytest

from mailweir.streaming import ingest
from mailweir.streaming.metrics import OUTCOMES, batch_metrics
from test_sources import CUTOFF, land, message


def _run(spark, tmp_path, name="one"):
    return ingest.ingest_landed(
        spark, str(tmp_path / "landing"), str(tmp_path / "mail"), str(tmp_path / f"{name}-checkpoint"), CUTOFF,
        ["news@a"], files_per_batch=None, metrics=str(tmp_path / "metrics"),
    )


def _rows(spark, tmp_path):
    found = batch_metrics(spark, str(tmp_path / "metrics")).orderBy("batch_id").collect()
    return [(r["batch_id"], r["input_rows"], *(r[o] for o in OUTCOMES)) for r in found]


def test_figures_are_complete_over_restarts(spark, tmp_path, monkeypatch):
    land(tmp_path / "landing", "1.json", [message("a"), message("b"), message("b"), message("c", sender="x@y")])
    _run(spark, tmp_path)
    land(tmp_path / "landing", "2.json", [message("a"), message("d", day=1), message("e")])
    real = ingest.write_mail

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    # The batch is logged and noted, and then breaks off before its rows are stored.
    monkeypatch.setattr(ingest, "write_mail", lost)
    with pytest.raises(Exception, match="lost"):
        _run(spark, tmp_path)
    monkeypatch.setattr(ingest, "write_mail", real)
    _run(spark, tmp_path)
    _run(spark, tmp_path)
    assert _rows(spark, tmp_path) == [(0, 4, 2, 1, 1, 0, 0), (1, 3, 1, 1, 0, 1, 0)]
    queries = batch_metrics(spark, str(tmp_path / "metrics")).select("query").distinct().count()
    assert queries == 1 and spark.read.parquet(str(tmp_path / "mail")).count() == 3


def test_no_figures_before_the_first_batch(spark, tmp_path):
    assert batch_metrics(spark, str(tmp_path / "metrics")).count() == 0
