"""Long allowlists are looked up by pieces of one length."""

import random

import pytest
from pyspark.sql import functions as F

from mailweir.operators import screen


def senders(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, `from` string")


def listed(spark, entries):
    return spark.createDataFrame([(e,) for e in entries], "sender string")


def drawn(seed, n, longest, letters="ab@."):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 3, 6])
@pytest.mark.parametrize("shortest", [0, 1, 5])
def test_matches_are_substrings_of_any_length(spark, piece, shortest):
    texts = drawn(1, 300, 30) + [None, "", "é@ü.example and more"]
    entries = [e for e in drawn(2, 60, 12) if len(e) >= shortest] + ["é@ü.example"]
    found = screen.matching_senders(senders(spark, texts), listed(spark, entries), piece=piece)
    want = {t or "" for t in texts if any(e in (t or "") for e in entries)}
    assert sorted(r["_sender"] for r in found.collect()) == sorted(want)


def test_fifty_lengths_make_one_piece_a_position(spark):
    entries = ["x" * 3 + str(n) * n for n in range(4, 54)]
    assert len({len(e) for e in entries}) == 50
    df = senders(spark, ["a" * 100])
    plan = screen.matching_senders(df, listed(spark, entries))._jdf.queryExecution().optimizedPlan().toString()
    # One stretch of one length, and no stretches for entries' own lengths.
    assert plan.count("sequence(1") == 1
    assert df.select(F.size(screen._pieces(F.col("from"), screen.PIECE)).alias("k")).first()["k"] == 1
    cut = senders(spark, ["".join(chr(97 + k % 26) + str(k) for k in range(40))])
    length = cut.select(F.length("from")).first()[0]
    assert cut.select(F.size(screen._pieces(F.col("from"), 6))).first()[0] == length - 5


def test_entries_of_one_domain_are_filed_apart(spark):
    entries = [f"{name}@same.example" for name in ("amelia.b", "bertram.c", "cassia.dd", "dominic.e")]
    filed = {r["_entry"]: r["_piece"] for r in screen.filed_entries(listed(spark, entries)).collect()}
    assert set(filed) == set(entries) and len(set(filed.values())) == 4


def test_bodies_are_not_shuffled(spark):
    mail = senders(spark, [f"s{n % 9}@x.example" for n in range(90)]).withColumn("body", F.repeat(F.lit("b"), 50))
    allow = listed(spark, [f"s{n}@" for n in range(4)] + ["y" * 20])
    for got in (
        screen.sender_allow(mail, allow, inline=0),
        screen.with_sender_match(mail, allow, inline=0).filter("_sender_ok").drop("_sender_ok"),
    ):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted(r["n"] for r in got.collect()) == [n for n in range(90) if n % 9 < 4]


def test_many_senders_found_are_joined(spark, monkeypatch):
    monkeypatch.setattr(screen, "BROADCAST_BYTES", 10)
    mail = senders(spark, [f"s{n % 9}@x.example" for n in range(90)])
    got = screen.sender_allow(mail, listed(spark, ["s1@", "s2@x.e"]), inline=0)
    assert sorted(r["n"] for r in got.collect()) == [n for n in range(90) if n % 9 in (1, 2)]


def test_a_missing_entry_is_an_error(spark):
    with pytest.raises(ValueError):
        screen.sender_allow(senders(spark, ["a"]), listed(spark, ["abcdefgh", None]), inline=0)
