"""Operators against brute force on small fixtures, with the skew paths forced on."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailweir.operators import combine, increment, order, profile, screen, sequence, skew
from mailweir.plans.verify import run_status

UTC = dt.timezone.utc


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ skew

@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    keys = ["hot"] * 300 + [f"k{rng.randrange(150)}" for _ in range(500)] + [None] * 40
    rng.shuffle(keys)
    left = spark.createDataFrame(list(enumerate(keys)), "n int, k string").repartition(7)
    right = spark.createDataFrame(
        [("hot", 1)] + [(f"k{i}", 1) for i in range(0, 150, 2)], "k string, v int"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_salted_join_equals_join(spark, skewed, how, broadcast):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        salted = skew.salted_join(left, right, "k", how, min_rows=50, salts=5)
        plain = left.join(right, "k", how)
        assert Counter(map(tuple, salted.select(*plain.columns).collect())) == Counter(
            map(tuple, plain.collect())
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_found_and_spread(skewed):
    left, _ = skewed
    assert rows(skew.hot_keys(left, "k", min_rows=50)) == [("hot",)]
    spread = left.filter("k = 'hot'").select(F.pmod(F.spark_partition_id(), F.lit(5))).distinct()
    assert spread.count() > 1


# ------------------------------------------------------------------ combining

@pytest.fixture(scope="module")
def stores(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2), ("2", 3), ("3", 4)], "id string, pos int")
    b = spark.createDataFrame([("2", 1), ("4", 2), ("4", 3), ("5", 4)], "id string, pos int")
    return a, b


def test_merge_keeps_repeats_unless_told(stores):
    a, b = stores
    assert rows(combine.merge_new(a, b)) == rows(a) + [("4", 2), ("4", 3), ("5", 4)]
    assert rows(combine.merge_new(a, b, ["pos"])) == rows(a) + [("4", 2), ("5", 4)]
    assert rows(combine.merge_new(a, b.limit(0))) == rows(a)


def test_sync_leaves_nothing_missing(stores):
    a, b = stores
    synced = combine.union_all(b, combine.sync_missing(a, b))
    assert combine.reconcile(a, synced).first()["only_in_a"] == 0
    assert rows(combine.difference(a, b)) == [("1",), ("3",)]


def test_reconcile_and_gate(stores, spark):
    a, b = stores
    assert tuple(combine.reconcile(a, b).first()) == (2, 2, True)
    assert tuple(combine.verify_gate(a, b).first()) == (4, 4, 4, False)
    assert tuple(combine.verify_gate(a, a).first()) == (4, 4, 0, True)
    # Equal sets do not pass if one side repeats an id.
    assert not combine.verify_gate(a, a.dropDuplicates(["id"])).first()["passed"]
    assert combine.sets_equal(a, a.dropDuplicates(["id"])).first()["equal"]
    assert run_status(a, b).first()["status"] == "completed_with_warnings"
    assert run_status(a, a).first()["status"] == "completed"
    none = a.limit(0)
    assert tuple(combine.verify_gate(none, none).first()) == (0, 0, 0, True)


def test_null_ids_do_not_empty_a_difference(spark, stores):
    a, _ = stores
    with_null = spark.createDataFrame([(None, 1), ("1", 2)], "id string, pos int")
    assert rows(combine.skip_known(a, with_null)) == [("2", 2), ("2", 3), ("3", 4)]


def test_first_wins_trims_before_the_shuffle(stores):
    a, _ = stores
    first = combine.first_wins(a, ["pos"])
    assert rows(first) == [("1", 1), ("2", 2), ("3", 4)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_load_and_merge_counts(stores):
    a, b = stores
    assert profile.load_stats(b, a).first().asDict() == {
        "total_processed": 4, "successful": 2, "failed": 0, "duplicates": 2,
    }
    assert tuple(profile.merge_info(a, b).first()) == (4, 4, 3, 7)
    assert tuple(profile.load_stats(b.limit(0), a).first()) == (0, 0, 0, 0)


# ------------------------------------------------------------------ screening

def test_cutoff_is_strict_and_lets_undated_pass(spark):
    mail = spark.createDataFrame(
        [(1, "2024-11-13 23:59:59"), (2, "2024-11-14 00:00:00"), (3, None)], "n int, t string"
    ).select("n", F.col("t").cast("timestamp").alias("parsed_ts"))
    for moment in ("2024-11-14", "2024-11-14T00:00:00+00:00", dt.datetime(2024, 11, 14, tzinfo=UTC)):
        assert rows(screen.cutoff(mail, moment).select("n")) == [(2,), (3,)]


SENDERS = ["News <news@a.example>", "NEWS@A.EXAMPLE", "x", "", None, "a@b", "ab" * 30, "日本@例"]


@pytest.mark.parametrize(
    "entries", [[], ["news@"], ["NEWS", "zz"], [""], ["@", "本@"], ["ab" * 20, "example>", "x"]]
)
def test_sender_allow_both_ways(spark, entries):
    mail = spark.createDataFrame(list(enumerate(SENDERS)), "n int, `from` string")
    want = [(i,) for i, s in enumerate(SENDERS) if any(e in (s or "") for e in entries)]
    allow = spark.createDataFrame([(e,) for e in entries], "sender string")
    assert rows(screen.sender_allow(mail, entries).select("n")) == want
    assert rows(screen.sender_allow(mail, allow, inline=0).select("n")) == want
    flagged = screen.with_sender_match(mail, allow, inline=0)
    assert rows(flagged.filter("_sender_ok").select("n")) == want
    assert flagged.count() == len(SENDERS)


def test_a_long_allowlist_compares_no_pairs(spark):
    mail = spark.createDataFrame(list(enumerate(SENDERS)), "n int, `from` string")
    allow = spark.createDataFrame([(f"u{i}@",) for i in range(200)], "sender string")
    plan = screen.sender_allow(mail, allow)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_labels(spark):
    mail = spark.createDataFrame([(1, ["A", "B"]), (2, ["C"]), (3, None), (4, [])], "n int, labelIds array<string>")
    assert rows(screen.label_filter(mail, ["B", "C"]).select("n")) == [(1,), (2,)]


def replay(messages, known, cutoff, allow):
    """The scan as a loop over messages in order."""
    seen, out = set(known), []
    for pos, ident, sender, ts in messages:
        if ident is None:
            out.append((pos, "error"))
        elif ident in seen:
            out.append((pos, "duplicate"))
        elif ts is not None and ts < cutoff:
            out.append((pos, "cutoff"))
        elif not any(e in (sender or "") for e in allow):
            out.append((pos, "filtered"))
        else:
            seen.add(ident)
            out.append((pos, "success"))
    return sorted(out)


def test_outcomes_equal_a_replay(spark):
    rng = random.Random(11)
    cutoff = dt.datetime(2024, 11, 14)
    messages = [
        (pos, rng.choice([None] + [f"m{i}" for i in range(60)]), rng.choice(["a@x", "b@x", None]),
         rng.choice([None, cutoff, cutoff - dt.timedelta(days=1), cutoff + dt.timedelta(days=1)]))
        for pos in range(400)
    ]
    scanned = spark.createDataFrame(messages, "pos int, id string, `from` string, parsed_ts timestamp")
    known = spark.createDataFrame([("m1",), ("m2",), ("zz",)], "id string")
    got = screen.outcome(scanned, known, cutoff.replace(tzinfo=UTC), ["a@"]).cache()
    assert rows(got.select("pos", "outcome")) == replay(messages, {"m1", "m2"}, cutoff, ["a@"])
    stats = profile.run_stats(got).first()
    assert stats["successful"] + stats["skipped"] + stats["cutoff"] + stats["errors"] == 400


# ------------------------------------------------------------------ ordered scans

def stops_by_replay(scan, limit):
    stops, runs = {}, Counter()
    for box, pos, outcome in sorted(scan, key=lambda r: r[1]):
        if box in stops:
            continue
        if outcome == "cutoff":
            runs[box] += 1
            if runs[box] >= limit:
                stops[box] = pos
        elif outcome == "success":
            runs[box] = 0
    return stops


@pytest.mark.parametrize("chunk", [1, 3, 8, 64, 1 << 18])
@pytest.mark.parametrize("limit", [1, 2, 5])
def test_early_stop_equals_a_replay(spark, chunk, limit):
    rng = random.Random(chunk * 10 + limit)
    scan = []
    for pos in range(600):
        weights = [6, 1, 4]
        scan.append((rng.randrange(8), pos * 2, rng.choices(["cutoff", "success", "filtered"], weights)[0]))
    df = spark.createDataFrame(scan, "mailbox int, pos int, outcome string")
    stops = sequence.early_stop(df, limit=limit, chunk=chunk)
    want = stops_by_replay(scan, limit)
    assert dict(map(tuple, stops.collect())) == want
    kept = [r for r in scan if r[1] <= want.get(r[0], 1 << 30)]
    assert rows(sequence.until_stop(df, stops).select("mailbox", "pos", "outcome")) == sorted(kept)


@pytest.mark.parametrize("chunk", [1, 4, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_prefix_scan(spark, chunk, inclusive):
    rng = random.Random(chunk)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([None, *range(-5, 20)])) for i in range(200)]
    df = spark.createDataFrame(data, "k string, pos int, v int")
    got = sequence.prefix_scan(
        df, ["k"], "pos", {"s": ("sum", "v"), "hi": ("max", "v"), "lo": ("min", "v")}, chunk, inclusive
    )
    want = []
    for key, pos, value in data:
        before = [v for k, p, v in data if k == key and (p <= pos if inclusive else p < pos) and v is not None]
        want.append((pos, sum(before) if before else None, max(before, default=None), min(before, default=None)))
    assert sorted(map(tuple, got.select("pos", "s", "hi", "lo").collect()), key=lambda r: r[0]) == want


def test_progress_never_counts_twice(spark):
    polls = spark.createDataFrame(
        [(1, 10, 12), (2, 11, None), (3, 15, 12), (4, 15, 15), (5, 9, 20), (6, 18, 20)],
        "seq int, count_a bigint, count_b bigint",
    )
    tracked = sequence.progress(polls, initial=10, chunk=2)
    assert rows(tracked.select("seq", "current", "new", "total_processed")) == [
        (1, 12, 2, 2), (2, 11, 0, 2), (3, 15, 3, 5), (4, 15, 0, 5), (5, 20, 5, 10), (6, 20, 0, 10),
    ]
    # The store's own count decides in the end: 18 - 10, not the 10 that were tracked.
    assert tuple(sequence.final_progress(tracked, initial=10).first()) == (10, 18, 10, 8, True)


# ------------------------------------------------------------------ profile, order, increment

def mail_of(spark, *dates):
    made = spark.createDataFrame([(f"m{i}", d) for i, d in enumerate(dates)], "id string, t string")
    return made.select("id", F.col("t").cast("timestamp").alias("parsed_ts"))


def test_empty_tables_report_nothing_but_do_not_fail(spark):
    from mailweir.plans.verify import quality_report, store_comparison
    from mailweir.sources.tables import empty_mail

    mail = empty_mail(spark)
    report = {name: df.collect() for name, df in quality_report(mail).items()}
    assert report["summary"][0]["total"] == 0 and report["summary"][0]["avg_length"] is None
    assert report["daily"] == [] and report["top_senders"] == []
    assert store_comparison(mail, mail)["gate"].first()["passed"]


def test_ranges_skip_undated(spark):
    mail = mail_of(spark, "2024-11-02", None, "2024-11-01")
    assert [str(x) for x in profile.date_range(mail).first()] == ["2024-11-01 00:00:00", "2024-11-02 00:00:00"]
    assert sum(r["n"] for r in profile.daily(mail).collect()) == 3
    age = profile.freshness(mail, screen.as_instant("2024-11-03T00:00:10+00:00")).first()[0]
    assert age == 86410


def test_daily_is_sorted_with_undated_first(spark):
    days = [r["day"] for r in profile.daily(mail_of(spark, "2024-11-02", None, "2024-11-01")).collect()]
    assert days[0] is None and days[1] < days[2]


def test_positions_are_dense_and_in_order(spark):
    mail = mail_of(spark, *[f"2024-11-{1 + i % 5:02d}" if i % 3 else None for i in range(300)])
    numbered = order.with_position(mail, order.recent_order())
    got = [tuple(r) for r in numbered.orderBy("position").select("position", "id").collect()]
    want = [r["id"] for r in order.sort_recent(mail).collect()]
    assert got == list(enumerate(want, 1))


def test_top_k_breaks_ties_by_key(spark):
    mail = spark.createDataFrame([(s,) for s in ["b", "a", "c", "c", None, None]], "`from` string")
    assert [tuple(r) for r in profile.top_senders(mail, 3).collect()] == [(None, 2), ("c", 2), ("a", 1)]


def test_categories_count_a_message_once(spark):
    mail = spark.createDataFrame([("m1", "tea tea coffee"), ("m2", "tea"), ("m3", "")], "id string, s string")
    rules = [("hot", "tea"), ("hot", "coffee"), ("bean", "coffee")]
    rowsets = profile.category_share(profile.with_category(mail, F.col("s"), rules))
    assert rows(rowsets) == [("bean", 1, 1 / 3), ("hot", 2, 2 / 3)]


@pytest.mark.parametrize(
    "dates, cutoff, mode, want",
    [
        ([], "2024-11-14", "reference", ("initial", "2024-11-14", None, "forward")),
        (["2024-11-20 23:00:00"], "2024-11-14", "reference", ("historical", "2024-11-14", "2024-11-20", "backward")),
        (["2024-11-10", "2024-11-20"], "2024-11-14", "reference", ("historical", "2024-11-14", "2024-11-20", "forward")),
        (["2024-11-20 23:00:00"], "2024-12-01", "reference", ("newer", "2024-11-21", None, "forward")),
        (["2024-11-20 23:00:00"], "2024-11-14", "forward", ("newer", "2024-11-20", None, "backward")),
        ([None], "2024-11-14", "forward", ("initial", "2024-11-14", None, "forward")),
    ],
)
def test_increment_plans(spark, dates, cutoff, mode, want):
    if dates:
        mail = mail_of(spark, *dates)
    else:
        mail = mail_of(spark, "2024-01-01").limit(0)
    plan = increment.plan_increment(mail, cutoff, mode).first()
    shown = tuple(None if x is None else str(x) for x in plan[:4])
    assert shown == want


def test_increment_keeps_undated(spark):
    mail = mail_of(spark, "2024-11-13", "2024-11-14", "2024-11-20", None).withColumn("mail_date", F.to_date("parsed_ts"))
    window = increment.apply_increment(mail, dt.date(2024, 11, 14), dt.date(2024, 11, 20))
    assert rows(window.select("id")) == [("m1",), ("m3",)]


@pytest.mark.parametrize("gap", [1, 7, 300_000])
def test_sparse_positions_stop_at_the_same_message(spark, gap):
    outcomes = [["cutoff", "success", "filtered", "cutoff"][n * n * 7 % 11 % 4] for n in range(60)]
    outcomes += ["cutoff"] * 3 + ["filtered"] * 9 + ["cutoff"] * 9
    scan = spark.createDataFrame([("m", gap * n, o) for n, o in enumerate(outcomes)], "mailbox string, pos bigint, outcome string")
    run, want = 0, None
    for n, o in enumerate(outcomes):
        run = 0 if o == "success" else run + (o == "cutoff")
        want = n if want is None and run == 5 else want
    for chunk in (2, 5, 1 << 18):
        assert [tuple(r) for r in sequence.early_stop(scan, chunk=chunk).collect()] == [("m", gap * want)]


def test_no_window_holds_a_sparse_sequence(spark):
    rows = spark.range(3000).select((F.col("id") * 300_000 + 1_700_000_000_000).alias("pos"), F.col("id").alias("v"))
    got = sequence.prefix_scan(rows, [], "pos", {"s": ("sum", "v")}, chunk=64).orderBy("pos").collect()
    assert [r["s"] for r in got] == [n * (n + 1) // 2 for n in range(3000)]


def test_adaptive_execution_splits_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        right = left.select("k").distinct()
        for how in ("left", "left_semi", "left_anti"):
            joined = skew.skew_join(left, right, "k", how)
            assert len(joined.collect()) == (0 if how == "left_anti" else 60_000)
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
