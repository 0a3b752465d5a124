"""Snapshots name files: they cost no data, and stay exact whatever happens to the table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailweir.sources import snapshots, tables

AT = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def mail(spark, *ids):
    rows = [(i, dt.datetime(2024, 11, 1 + n % 3)) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "id string, parsed_ts timestamp")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_snapshot_copies_no_data_and_outlives_appends(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    tables.write_mail(mail(spark, "a", "b", "c"), table)
    before = sorted((tmp_path / "mail").rglob("*.parquet"))
    name = snapshots.snapshot(spark, table, root, AT)
    assert sorted((tmp_path / "mail").rglob("*.parquet")) == before
    assert snapshots.manifest(spark, root, name).count() == len(before)
    assert not list((tmp_path / "snaps").rglob("mail_date=*"))
    tables.write_mail(mail(spark, "d", "e"), table, mode="append")
    assert ids(snapshots.read_snapshot(spark, root)) == ["a", "b", "c"]
    assert ids(tables.read_mail(spark, table)) == ["a", "b", "c", "d", "e"]
    plan = snapshots.read_snapshot(spark, root).filter(F.col("mail_date") == dt.date(2024, 11, 2))
    assert ids(plan) == ["b"] and "PartitionFilters: [" in plan._jdf.queryExecution().toString()
    snapshots.restore(spark, root, table)
    assert ids(tables.read_mail(spark, table)) == ["a", "b", "c"]


def test_every_generation_of_a_table_can_be_read(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    names = []
    for n in range(3):
        tables.write_mail(mail(spark, f"m{n}"), table)
        names.append(snapshots.snapshot(spark, table, root, AT + dt.timedelta(microseconds=n)))
    assert len(set(names)) == 3 and snapshots.snapshots(spark, root) == sorted(names)
    assert [snapshots.moment_of(n) for n in names] == [AT + dt.timedelta(microseconds=n) for n in range(3)]
    snapshots.restore(spark, root, table, names[0])
    assert [ids(snapshots.read_snapshot(spark, root, n)) for n in names] == [["m0"], ["m1"], ["m2"]]


def test_retention_forgets_old_lists_and_what_only_they_name(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    names = []
    for n in range(3):
        tables.write_mail(mail(spark, f"m{n}"), table)
        names.append(snapshots.snapshot(spark, table, root, AT + dt.timedelta(days=n)))
    assert snapshots.retain(spark, root, 2) == names[:1]
    assert snapshots.snapshots(spark, root) == names[1:]
    assert len(list((tmp_path / "mail-replaced").iterdir())) == 1
    assert ids(snapshots.read_snapshot(spark, root, names[1])) == ["m1"]
    assert snapshots.retain(spark, root, 0) == names[1:]
    assert ids(tables.read_mail(spark, table)) == ["m2"]


def test_a_missing_snapshot_leaves_the_table_alone(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    tables.write_mail(mail(spark, "a"), table)
    snapshots.snapshot(spark, table, root, AT)
    for name, folder in (("20240101_000000", root), (None, str(tmp_path / "none"))):
        with pytest.raises(FileNotFoundError):
            snapshots.restore(spark, folder, table, name)
    assert ids(tables.read_mail(spark, table)) == ["a"]


def test_an_empty_table_has_an_empty_snapshot(spark, tmp_path):
    table, root = str(tmp_path / "mail"), str(tmp_path / "snaps")
    tables.write_mail(mail(spark, "a").limit(0), table)
    snapshots.snapshot(spark, table, root, AT)
    assert snapshots.read_snapshot(spark, root).count() == 0
