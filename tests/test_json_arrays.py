"""Arrays of objects are taken apart wherever a task begins to read."""

import json
import random

import pytest

from mailweir.sources import jsonarray


def objects(seed, n):
    draw = random.Random(seed)
    parts = ['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "é", "x", "},{", '\\"', "\\\\", "    {\n"]
    text = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(9)))
    return [{"id": k, text() + str(k): text(), "in": {"deep": [{"er": text()}, text()], "e": {}}} for k in range(n)]


def read(spark, path):
    return sorted((json.loads(r["value"]) for r in jsonarray.read_objects(spark, str(path)).collect()), key=lambda o: o["id"])


@pytest.mark.parametrize("indent, separators", [(None, None), (None, (",", ":")), (2, None), (4, None)])
@pytest.mark.parametrize("split", [None, 64])
def test_any_layout_gives_the_objects(spark, tmp_path, indent, separators, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    want = objects(indent or 1, 60)
    (tmp_path / "a.json").write_text(json.dumps(want, indent=indent, separators=separators, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps([], indent=indent))
    (tmp_path / "c.json").write_text(" \n" + json.dumps([{"id": 1000}]) + "\n")
    try:
        if split:
            # Tasks begin inside records, strings and escapes.
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.files.openCostInBytes", 0)
        assert read(spark, tmp_path) == [*want, {"id": 1000}]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = [{"id": k, "text": "y{" * 500} for k in range(400)]
    (tmp_path / "a.json").write_text(json.dumps(want))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
        pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
        tasks = pieces.selectExpr("spark_partition_id() AS p").distinct().count()
        assert tasks > 1 and read(spark, tmp_path) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_arrays_are_arrays(spark, tmp_path):
    want = objects(5, 40)
    rows = spark.createDataFrame([(json.dumps(o),) for o in want], "value string").repartition(3)
    jsonarray.write_objects(rows, str(tmp_path / "out"))
    held = [o for f in (tmp_path / "out").rglob("*.txt") for o in json.loads(f.read_text())]
    assert sorted(held, key=lambda o: o["id"]) == want == read(spark, tmp_path / "out")
