"""What the plans must and must not contain."""

import types

import pytest

from conftest import SF_DIR
from mailweir import session
from mailweir.operators.screen import sender_allow
from mailweir.plans.ingest import screened_mail
from mailweir.registry import QUERIES, bodies, collections, derive, profiling, screening

LAZY = sorted(
    name for group in (profiling, collections, screening, bodies) for name in group.QUERIES
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["top_senders", "top_k", "keywords", "themes", "sample"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["top_senders"](spark, SF_DIR))
    assert "ReadSchema: struct<lang:string,source:string,n_chars:bigint>" in plan
    assert "text" not in plan_of(QUERIES["daily"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["quality_summary", "content_stats", "null_audit"])
def test_a_report_is_one_scan(spark, name):
    assert plan_of(QUERIES[name](spark, SF_DIR)).count("FileScan") == 1


def test_comparing_stores_needs_no_join(spark):
    for name in ("reconcile", "verify_gate", "merge_info"):
        assert "Join" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_screening_and_decoding_do_not_shuffle(spark):
    raw = derive.raw_pages(spark, SF_DIR)
    before = plan_of(raw).count("Exchange")
    assert plan_of(screened_mail(raw, derive.CUTOFF, derive.ALLOW)).count("Exchange") == before


def test_bodies_are_decoded_after_screening(spark):
    plan = plan_of(screened_mail(derive.raw_documents(spark, SF_DIR), derive.CUTOFF, derive.ALLOW))
    lines = plan.splitlines()
    decoded = next(i for i, line in enumerate(lines) if "clean_text" in line)
    filtered = next(i for i, line in enumerate(lines) if "Filter" in line and "src1@" in line)
    assert decoded < filtered  # a plan is read from the bottom up


def test_sender_filter_is_generated_code(spark):
    plan = plan_of(sender_allow(derive.mail(spark, SF_DIR), derive.ALLOW).select("pos"))
    assert "Join" not in plan and "*(1)" in plan


def test_shared_folder(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")

    def unnamed(master):
        return types.SimpleNamespace(
            conf=types.SimpleNamespace(get=lambda key, default: default),
            sparkContext=types.SimpleNamespace(master=master, applicationId="app"),
        )

    monkeypatch.setattr(session, "_LOCAL_DIRS", {})
    local = unnamed("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(RuntimeError):
        session.shared_dir(unnamed("yarn"))


def test_small_tables_are_dealt_out(spark):
    assert session.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 16)
    assert session.spread(wide) is wide
