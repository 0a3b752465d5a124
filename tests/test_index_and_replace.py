"""The index of stored ids, and replacing a table, at every step they can break off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailweir.sources import files, idindex, load, snapshots, tables

AT = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def mail(spark, *ids):
    rows = [(i, str(n), dt.datetime(2024, 11, 1 + n % 3)) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "id string, internalDate string, parsed_ts timestamp")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "mail")


def stored(spark, table):
    return ids(tables.read_mail(spark, table))


def filed(spark, table):
    return ids(idindex.entries(spark, table))


# ---- index -----------------------------------------------------------------------------

def test_loads_by_the_index_add_each_id_once(spark, table):
    load.load_insert_only(mail(spark, "a", "b", "b"), table)
    assert not idindex.exists(spark, table)
    stats = load.load_insert_only(mail(spark, "b", "c", "c", None), table, index=True)
    assert (stats.successful, stats.duplicates, stats.failed) == (1, 2, 1)
    assert load.load_insert_only(mail(spark, "a", "c", "d"), table).successful == 1
    assert stored(spark, table) == filed(spark, table) == ["a", "b", "c", "d"]
    tables.write_mail(mail(spark, "e"), table, mode="append")
    assert filed(spark, table)[-1] == "e"
    idindex.compact(spark, table)
    assert filed(spark, table) == ["a", "b", "c", "d", "e"]
    assert load.load_insert_only(mail(spark, "a", "e", "f"), table).successful == 1


def test_a_batch_opens_only_its_buckets(spark, table):
    load.load_insert_only(mail(spark, *[f"m{n}" for n in range(300)]), table, index=True)
    asked = spark.createDataFrame([("m7",), ("new",), (None,)], "id string")
    found = idindex.hits(spark, table, asked)
    assert ids(found) == ["m7"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    bucket = spark.createDataFrame([("m7",)], "id string").select(idindex._bucket()).first()[0]
    assert f"bucket#" in plan and f"IN ({bucket})" in plan or f"= {bucket})" in plan
    assert "PartitionFilters: [" in plan
    # An id whose bit is not set is not looked for at all.
    assert idindex._asked(spark, table, asked).count() <= 2
    assert "mail_date" not in plan


def test_nothing_asked_or_stored(spark, table):
    idindex.build(spark, table)
    assert idindex.hits(spark, table, mail(spark, "a")).count() == 0
    load.load_insert_only(mail(spark, "a"), table)
    assert idindex.hits(spark, table, mail(spark, "a").limit(0)).count() == 0
    assert stored(spark, table) == filed(spark, table) == ["a"]


class Crash(RuntimeError):
    pass


def crash():
    raise Crash


@pytest.mark.parametrize("step", ["before the rows", "after the rows", "while recovering"])
def test_a_load_that_breaks_off_loses_and_doubles_nothing(spark, table, step, monkeypatch):
    load.load_insert_only(mail(spark, "a", "b"), table, index=True)
    new = mail(spark, "c", "d")
    with pytest.raises(Crash):
        def write():
            if step != "before the rows":
                tables.spread_by_day(tables.conform(new)).write.mode("append").partitionBy(tables.DAY).parquet(table)
            crash()

        idindex.appended(spark, table, new.select("id"), write)
    if step == "while recovering":
        with monkeypatch.context() as patch:
            patch.setattr(idindex, "appended", lambda *a: crash())
            with pytest.raises(Crash):
                load.load_insert_only(new, table)
    stats = load.load_insert_only(mail(spark, "b", "c", "d", "e"), table)
    assert stats.successful == (3 if step == "before the rows" else 1)
    assert stored(spark, table) == ["a", "b", "c", "d", "e"]
    assert sorted(set(filed(spark, table))) == ["a", "b", "c", "d", "e"]
    assert idindex.recover(spark, table) == []


def test_an_unfinished_generation_does_not_count(spark, table, monkeypatch):
    load.load_insert_only(mail(spark, "a"), table, index=True)
    with monkeypatch.context() as patch:
        patch.setattr(idindex, "create", lambda *a: crash())
        with pytest.raises(Crash):
            idindex.compact(spark, table)
    assert filed(spark, table) == ["a"]
    idindex.compact(spark, table)
    assert filed(spark, table) == ["a"] and load.load_insert_only(mail(spark, "a", "b"), table).successful == 1


def test_a_replaced_table_loses_its_index(spark, table, tmp_path):
    load.load_insert_only(mail(spark, "a"), table, index=True)
    root = str(tmp_path / "snaps")
    snapshots.snapshot(spark, table, root, AT)
    load.load_insert_only(mail(spark, "b"), table)
    snapshots.restore(spark, root, table)
    assert not idindex.exists(spark, table)
    assert load.load_insert_only(mail(spark, "b"), table, index=True).successful == 1
    assert stored(spark, table) == filed(spark, table) == ["a", "b"]


def test_sync_by_the_index(spark, table, tmp_path):
    source = str(tmp_path / "source")
    tables.write_mail(mail(spark, "a", "b", "c"), source)
    load.load_insert_only(mail(spark, "b"), table, index=True)
    stats, equal = load.sync(spark, source, table)
    assert (stats.successful, equal) == (2, True)


# ---- replacement -----------------------------------------------------------------------

@pytest.mark.parametrize("snapped", [False, True])
@pytest.mark.parametrize("step", range(6))
def test_replacing_leaves_the_old_or_the_new_table(spark, table, tmp_path, step, snapped, monkeypatch):
    tables.write_mail(mail(spark, "old"), table)
    root = str(tmp_path / "snaps")
    if snapped:
        snapshots.snapshot(spark, table, root, AT)
    calls = []

    def after(real):
        def run(*args):
            if len(calls) == step:
                calls.append("crash")
                crash()
            calls.append(real.__name__)
            return real(*args)
        return run

    with monkeypatch.context() as patch:
        for name in ("create", "move", "remove"):
            patch.setattr(tables, name, after(getattr(files, name)))
        try:
            tables.write_mail(mail(spark, "new"), table)
            broke = False
        except Crash:
            broke = True
    assert stored(spark, table) in ([["old"], ["new"]] if broke else [["new"]])
    # The next writer finishes what was announced, and loses nothing of it.
    held = stored(spark, table)
    load.load_insert_only(mail(spark, "more"), table)
    assert stored(spark, table) == sorted(held + ["more"]) or (broke and stored(spark, table) == ["more", "new"])
    if snapped:
        assert ids(snapshots.read_snapshot(spark, root)) == ["old"]
    tables.write_mail(tables.read_mail(spark, table).filter(F.col("id") == "more"), table)
    assert stored(spark, table) == ["more"]
