"""Landing follows the source: many partitions land in many tasks, and the batches stay as many."""

import pytest
from conftest import SF_DIR

from mailweir.registry import streams

BATCHES = {"stream_batches": 2, "stream_progress": 8}


def landed(tmp_path):
    return sorted((tmp_path / "run" / "landing").glob("part-*"))


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "run_dir", lambda *_: str(tmp_path / "run"))

    def over(name, sf):
        return streams.QUERIES[name](spark, str(sf)).first()

    return over


@pytest.mark.parametrize("name, parts", [("stream_batches", 19), ("stream_progress", 30)])
def test_tasks_that_land_grow_with_the_source(spark, tmp_path, run, name, parts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.count()
    docs.repartition(parts).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    cost, before = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes")
    # One partition a file.
    spark.conf.set(cost, str(1 << 30))
    try:
        found = run(name, tmp_path / "sf")
    finally:
        spark.conf.set(cost, before)
    assert (found["batches"], found["input_rows"]) == (BATCHES[name], rows)
    # A file's name begins with the number of the task that wrote it.
    assert len({f.name.split("-")[1] for f in landed(tmp_path)}) == parts
    assert max(len(f.read_text().splitlines()) for f in landed(tmp_path)) <= -(-rows // parts) + 1


def test_fewer_rows_than_files_are_read_once(spark, tmp_path, run):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(3)
    docs.coalesce(1).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    found = run("stream_batches", tmp_path / "sf")
    assert found["input_rows"] == 3 and 1 <= found["batches"] <= 2
