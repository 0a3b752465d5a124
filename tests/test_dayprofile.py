"""The profile kept per day: equal to the report over all rows, whatever loads and crashes came before."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailweir.operators import profile
from mailweir.plans import dayprofile
from mailweir.plans.ingest import RunPaths, run_ingest
from mailweir.plans.verify import quality_report
from mailweir.sources import raw, tables
from test_sources import CUTOFF, land, message

_SCHEMA = (
    "id string, `from` string, subject string, parsed_ts timestamp, "
    "body struct<clean_text:string,urls:array<string>,length:int>"
)


def _mail(spark, *entries):
    """Messages from ``(id, sender, subject, day, text)``."""
    data = [
        (i, sender, subject, day and dt.datetime(2024, 11, day),
         None if text is None else (text, [w for w in text.split() if w.startswith("http")], len(text)))
        for i, sender, subject, day, text in entries
    ]
    return spark.createDataFrame(data, _SCHEMA)


FIRST = [
    ("1", "a@x", "Weekly report ready", 1, "one http://a.example"), ("2", "b@x", None, 1, ""),
    ("3", None, "The weekly news", 2, None), ("4", "a@x", "ready", None, "four"), (None, "c@x", "odd", 2, "five"),
]
SECOND = [("5", "b@x", "weekly", 2, "x" * 5000), ("1", "a@x", "Weekly report ready", 1, "one again"), (None, "c@x", "odd", 3, "six")]
THIRD = [("1", "a@x", "weekly", 9, "third copy"), ("6", "d@x", "new", 9, ""), ("6", "d@x", "new", 9, "")]


def _load(spark, table, entries):
    tables.write_mail(_mail(spark, *entries), table, mode="append")


def _shown(report):
    return {name: [tuple(r) for r in section.collect()] for name, section in report.items()}


def _same(spark, table):
    got, want = dayprofile.report(spark, table), quality_report(tables.read_mail(spark, table))
    assert got.keys() == want.keys()
    for name in want:
        assert got[name].columns == want[name].columns, name
    assert _shown(got) == _shown(want)


def test_every_load_is_added_and_the_report_stays_that_of_all_rows(spark, tmp_path):
    table = str(tmp_path / "mail")
    for entries in (FIRST, SECOND, THIRD):
        _load(spark, table, entries)
        assert dayprofile.refresh(spark, table) > 0
        _same(spark, table)
    assert dayprofile.refresh(spark, table) == 0
    days = {r["day"]: r["total"] for r in dayprofile.days(spark, table).collect()}
    assert days == {None: 1, dt.date(2024, 11, 1): 3, dt.date(2024, 11, 2): 3, dt.date(2024, 11, 3): 1, dt.date(2024, 11, 9): 3}


def test_only_new_files_are_read(spark, tmp_path):
    table = str(tmp_path / "mail")
    _load(spark, table, FIRST)
    dayprofile.refresh(spark, table)
    assert dayprofile.pending(spark, table) == []
    _load(spark, table, THIRD)
    new = dayprofile.pending(spark, table)
    assert new and all(f.startswith("mail_date=2024-11-09/") for f in new)
    assert dayprofile.refresh(spark, table) == len(new)
    for section in dayprofile.report(spark, table).values():
        assert section.inputFiles() and all("/mail-profile/part-" in f for f in section.inputFiles())


def test_an_empty_table_has_an_empty_report(spark, tmp_path):
    table = str(tmp_path / "none")
    assert dayprofile.refresh(spark, table) == 0
    _same(spark, table)
    _load(spark, table, FIRST)
    dayprofile.refresh(spark, table)
    _same(spark, table)


@pytest.mark.parametrize("at", ["figures", "mark"])
def test_a_refresh_that_breaks_off_leaves_the_profile_before(spark, tmp_path, monkeypatch, at):
    table = str(tmp_path / "mail")
    _load(spark, table, FIRST)
    dayprofile.refresh(spark, table)
    before = _shown(dayprofile.report(spark, table))
    _load(spark, table, SECOND)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        name = {"figures": "items_by_day", "mark": "create"}[at]
        broken.setattr(dayprofile, name, fail)
        with pytest.raises(RuntimeError):
            dayprofile.refresh(spark, table)
    assert _shown(dayprofile.report(spark, table)) == before
    dayprofile.refresh(spark, table)
    _same(spark, table)


def test_a_replaced_table_is_profiled_anew(spark, tmp_path):
    table = str(tmp_path / "mail")
    _load(spark, table, FIRST)
    dayprofile.refresh(spark, table)
    tables.write_mail(_mail(spark, *SECOND), table)
    dayprofile.refresh(spark, table)
    _same(spark, table)
    assert len(list((tmp_path / "mail-profile").glob("part-*"))) == 1


def test_compacting_keeps_the_report(spark, tmp_path):
    table = str(tmp_path / "mail")
    for entries in (FIRST, SECOND, THIRD):
        _load(spark, table, entries)
        dayprofile.refresh(spark, table)
    assert len(list((tmp_path / "mail-profile").glob("part-*"))) == 3
    dayprofile.compact(spark, table)
    assert len(list((tmp_path / "mail-profile").glob("part-*"))) == 1
    _same(spark, table)
    assert dayprofile.refresh(spark, table) == 0
    _load(spark, table, [("7", "a@x", "weekly", 1, "seven")])
    dayprofile.refresh(spark, table)
    _same(spark, table)


def test_other_things_are_counted_as_well(spark, tmp_path):
    table = str(tmp_path / "mail")
    rules = (("week", "week"), ("any", "."))
    themes = F.split(F.lower("subject"), " ")
    counted = {"theme": themes, "category": profile.categories(F.lower("subject"), rules)}
    for entries in (FIRST, SECOND):
        _load(spark, table, entries)
        dayprofile.refresh(spark, table, counted)
    stored = tables.read_mail(spark, table)
    got = dayprofile.counts(spark, table, "theme").orderBy(F.desc("n"), "item").limit(10)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in profile.top_themes(stored, themes).collect()]
    want = profile.category_daily(profile.with_category(stored, F.lower("subject"), rules))
    got = dayprofile.counts(spark, table, "category", by_day=True)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    # Asked to count something else, it is made anew, and holds that alone.
    dayprofile.refresh(spark, table, {"theme": themes})
    assert dayprofile.counts(spark, table, "category").isEmpty()
    _same(spark, table)
    with pytest.raises(ValueError):
        dayprofile.refresh(spark, table, {"sender": themes})


def test_a_run_refreshes_the_profile(spark, tmp_path):
    table = str(tmp_path / "mail")
    paths = RunPaths(table, *(str(tmp_path / n) for n in ("snapshots", "log", "stats")))
    for name, days in (("one", (20, 21)), ("two", (21, 22))):
        land(tmp_path / name, "1.json", [message(f"d{n}", day=n) for n in days])
        landed = raw.read_raw(spark, str(tmp_path / name)).withColumn("pos", F.xxhash64("id"))
        run_ingest(spark, landed, paths, CUTOFF, ["@"], profile=True)
        assert dayprofile.pending(spark, table) == []
        _same(spark, table)
    assert dayprofile.report(spark, table)["summary"].first()["total"] > 0
