"""Faults found in use: lost text, days by session zone, ties, missing entries, forgotten progress."""

import datetime as dt
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day
from mailweir.functions.html import strip_markup
from mailweir.operators import profile, screen, skew
from mailweir.sources import allowlist, load, tables


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.text = []

    def handle_data(self, data):
        self.text.append(data)


def _parsed(html):
    parser = _Text()
    parser.feed(html)
    parser.close()
    return "".join(parser.text).split()


def _tags(seed):
    draw = random.Random(seed)
    values = ["it's", "o'k", '"a b"', "'x > y'", '"it\'s"', "'say \"no\"'", "a=b", "/p?q=1&r='", "7", '5"', "a\"b'c"]
    out = []
    for n in range(draw.randint(1, 6)):
        attributes = "".join(
            f" a{k}{draw.choice(['=', ' = ', '= '])}{draw.choice(values)}" if draw.random() < 0.8 else f" flag{k}"
            for k in range(draw.randint(0, 3))
        )
        out.append(f"<{draw.choice(['a', 'b', 'p', 'td'])}{attributes}> word{n} ")
    return "".join(out)


def test_markup_of_any_quoting_keeps_the_text(spark):
    pages = [_tags(seed) for seed in range(400)]
    pages += ["<a title=it's>one</a> two <a title=it's>three</a>", "<a href=x alt=it's>KEEP</a> and <b title=o'k>z</b>", "<p title=it's>text"]
    df = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
    got = {r["n"]: r["t"].split() for r in df.select("n", strip_markup(F.col("html")).alias("t")).collect()}
    assert {n: _parsed(p) for n, p in enumerate(pages)} == got


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def _mail(spark, *rows):
    schema = "id string, internalDate string, subject string, parsed_ts timestamp"
    rows = [(i, d, s, dt.datetime.fromisoformat(t) if t else None) for i, d, s, t in rows]
    return spark.createDataFrame(rows, schema)


def test_days_are_utc_days_in_any_session(spark, new_york, tmp_path):
    late = F.lit("2024-11-15T01:00:00Z").cast("timestamp")
    assert spark.range(1).select(utc_day(late).alias("d")).first()["d"] == dt.date(2024, 11, 15)
    old = F.lit("1969-12-31T23:59:59Z").cast("timestamp")
    assert spark.range(1).select(utc_day(old).alias("d")).first()["d"] == dt.date(1969, 12, 31)
    mail = spark.range(1).select(F.lit("m").alias("id"), late.alias("parsed_ts"), F.lit("1").alias("internalDate"))
    assert profile.daily(mail).first()["day"] == dt.date(2024, 11, 15)
    path = str(tmp_path / "mail")
    load.load_insert_only(mail, path, fixed_days=True)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert load.load_insert_only(mail, path, fixed_days=True).successful == 0


def test_the_earliest_copy_wins_by_number_and_ties_are_settled(spark, tmp_path):
    rows = [
        ("a", "1000000000000", "late", None), ("a", "999999999999", "early", None),
        ("b", "5", "x", None), ("b", "5", "y", None), ("b", None, "z", None),
    ]
    found = []
    for n, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"mail{n}")
        load.load_insert_only(_mail(spark, *order).repartition(3), path)
        found.append({r["id"]: r["subject"] for r in tables.read_mail(spark, path).collect()})
    assert found[0] == found[1] and found[0]["a"] == "early" and found[0]["b"] in "xy"


def test_only_the_days_of_the_batch_are_searched(spark, tmp_path):
    path = str(tmp_path / "mail")
    days = [f"2024-11-{d:02}T10:00:00" for d in range(1, 11)]
    load.load_insert_only(_mail(spark, *[(f"m{k}", "1", "s", t) for k, t in enumerate(days)]), path)
    batch = _mail(spark, ("new", "1", "s", days[2]), ("odd", "1", "s", "1970-01-01T00:00:00"), ("none", "1", "s", None))
    batch = batch.withColumn("mail_date", utc_day("parsed_ts"))
    searched = load.candidate_days(tables.read_mail(spark, path), batch)
    assert [r["id"] for r in searched.collect()] == ["m2"]
    assert "PartitionFilters: [" in searched._jdf.queryExecution().toString()


@pytest.mark.parametrize("extra", [0, 65])
def test_a_missing_entry_is_refused_by_either_path(spark, extra, tmp_path):
    entries = ["a@", None, *(f"x{k}@" for k in range(extra))]
    mail = spark.createDataFrame([("a@b",), ("c@d",), (None,)], "`from` string")
    listed = spark.createDataFrame([(e,) for e in entries], "sender string")
    for allow in (entries, listed):
        with pytest.raises(ValueError):
            screen.sender_allow(mail, allow).collect()
    (tmp_path / "allow.json").write_text('["a@", null]')
    with pytest.raises(Exception, match="array of strings"):
        allowlist.read_allowlist(spark, str(tmp_path / "allow.json")).collect()


def test_both_sides_of_a_salted_join_read_one_hot_list(spark):
    left = spark.range(2000).select((F.col("id") % 7 == 0).cast("int").alias("k"), "id")
    right = spark.range(2).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"))
    joined = skew.salted_join(left, right, "k", "inner", min_rows=100)
    assert joined.count() == 2000
    assert "approx_top_k" not in joined._jdf.queryExecution().optimizedPlan().toString()
