"""Joins, set operations and insert-only merging of two stores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from mailweir.operators import combine, profile
from mailweir.operators.project import id_projection
from mailweir.plans import verify
from mailweir.registry import derive as D
from mailweir.registry.derive import over_mail, over_stores, text_of, ts_sql
from mailweir.session import run_dir, stage
from mailweir.sources import load


def _stores(spark, sf):
    mail = D.mail(spark, sf).select("id", "pos", "lang", "subject")
    return D.store_a(mail), D.store_b(mail)


def _ids(df):
    return df.select("id", "pos")


def merge_new(spark, sf):
    a, b = _stores(spark, sf)
    return _ids(combine.merge_new(a, b))


def merge_new_dedup(spark, sf):
    a, b = _stores(spark, sf)
    return _ids(combine.merge_new(a, b, dedup_new=["pos"]))


def sync_missing(spark, sf):
    a, b = _stores(spark, sf)
    return _ids(combine.sync_missing(a, b))


def skip_known(spark, sf):
    a, b = _stores(spark, sf)
    return _ids(combine.skip_known(b, a))


def reconcile(spark, sf):
    return combine.reconcile(*_stores(spark, sf))


def _stored(spark, sf):
    """Both stores as tables of unique ids, with an index each."""
    paths, mail = [], D.mail(spark, sf)
    for df in (D.store_a(mail), D.store_b(mail)):
        path = run_dir(spark, "mail")
        load.load_insert_only(df, path, ["pos"], index=True)
        paths.append(path)
    return paths


def reconcile_digest(spark, sf):
    """``reconcile`` of two stored tables: ids are read of those buckets only whose digests differ."""
    return verify.reconcile_stored(spark, *_stored(spark, sf))


def stored_status(spark, sf):
    """The status of a run whose stores differ, and after each has been given what it lacks."""
    a, b = _stored(spark, sf)
    before = stage(verify.stored_status(spark, a, b).select(F.lit("before").alias("moment"), "*"), "status")
    load.sync(spark, a, b)
    load.sync(spark, b, a)
    return before.unionByName(
        verify.stored_status(spark, a, b).select(F.lit("after").alias("moment"), "*")
    )


def verify_gate(spark, sf):
    return combine.verify_gate(*_stores(spark, sf))


def verify_gate_after_sync(spark, sf):
    """Once each store has been given what it lacks, the gate must open."""
    a, b = _stores(spark, sf)
    both = combine.first_wins(combine.union_all(a, b), ["pos"])
    synced = combine.union_all(
        combine.first_wins(a, ["pos"]), combine.first_wins(combine.sync_missing(b, a), ["pos"])
    )
    return combine.verify_gate(both, synced)


def set_equality(spark, sf):
    return combine.sets_equal(*_stores(spark, sf))


def union_all(spark, sf):
    return _ids(combine.union_all(*_stores(spark, sf)))


def difference(spark, sf):
    a, b = _stores(spark, sf)
    forth = combine.difference(a, b).withColumn("only_in", F.lit("a"))
    return forth.unionByName(combine.difference(b, a).withColumn("only_in", F.lit("b")))


def distinct_ids(spark, sf):
    return combine.distinct_ids(D.mail(spark, sf))


def ids(spark, sf):
    return id_projection(D.mail(spark, sf))


def first_wins(spark, sf):
    return _ids(combine.first_wins(D.mail(spark, sf), ["pos"]))


def insertable(spark, sf):
    a, b = _stores(spark, sf)
    return _ids(combine.insertable(b, a, ["pos"]))


def load_stats(spark, sf):
    a, b = _stores(spark, sf)
    return profile.load_stats(b, a)


def merge_info(spark, sf):
    a, b = _stores(spark, sf)
    return profile.merge_info(a, b)


def run_status(spark, sf):
    return verify.run_status(*_stores(spark, sf))


def store_comparison(spark, sf):
    """All sections of the comparison of two stores, a row for each figure."""
    mail = D.mail(spark, sf).select("id", "parsed_ts", "from", "lang")
    found = verify.store_comparison(D.store_a(mail), D.store_b(mail))
    parts = [
        found["difference"].select(F.lit("only in a").alias("figure"), F.col("only_in_a").cast("string").alias("value")),
        found["difference"].select(F.lit("only in b"), F.col("only_in_b").cast("string")),
        found["gate"].select(F.lit("ids differing"), F.col("ids_differing").cast("string")),
        *[found[f"range_{s}"].select(F.lit(f"{end} in {s}"), text_of(F.col(end)))
          for s in "ab" for end in ("earliest", "latest")],
        found["top_senders"].select(F.concat(F.lit("from "), F.coalesce("from", F.lit("nobody"))), F.col("n").cast("string")),
    ]
    return reduce(lambda a, b: a.unionAll(b), parts)


QUERIES = {
    f.__name__: f
    for f in (
        merge_new, merge_new_dedup, sync_missing, skip_known, reconcile, reconcile_digest,
        stored_status, verify_gate,
        verify_gate_after_sync, set_equality, union_all, difference, distinct_ids, ids,
        first_wins, insertable, load_stats, merge_info, run_status,
        store_comparison,
    )
}

_NEW = "SELECT id, pos FROM b WHERE id NOT IN (SELECT id FROM a)"
_FIRST_NEW = "SELECT id, min(pos) AS pos FROM b WHERE id NOT IN (SELECT id FROM a) GROUP BY id"
_ONLY = "(SELECT count(*) FROM (SELECT id FROM {0} EXCEPT SELECT id FROM {1}))"

_GATE = f"""(SELECT count(*) FROM a) AS count_a, (SELECT count(*) FROM b) AS count_b,
  {_ONLY.format('a', 'b')} + {_ONLY.format('b', 'a')} AS ids_differing,
  (SELECT count(*) FROM a) = (SELECT count(*) FROM b)
    AND {_ONLY.format('a', 'b')} + {_ONLY.format('b', 'a')} = 0 AS passed"""

ORACLE = {
    "run_status": over_stores(
        f"SELECT *, CASE WHEN passed THEN 'completed' ELSE 'completed_with_warnings' END AS status FROM (SELECT {_GATE})"
    ),
    "store_comparison": over_stores(
        f"""SELECT 'only in a' AS figure, CAST({_ONLY.format('a', 'b')} AS VARCHAR) AS value
UNION ALL SELECT 'only in b', CAST({_ONLY.format('b', 'a')} AS VARCHAR)
UNION ALL SELECT 'ids differing', CAST({_ONLY.format('a', 'b')} + {_ONLY.format('b', 'a')} AS VARCHAR)
UNION ALL SELECT 'earliest in a', {ts_sql('min(ts)')} FROM a UNION ALL SELECT 'latest in a', {ts_sql('max(ts)')} FROM a
UNION ALL SELECT 'earliest in b', {ts_sql('min(ts)')} FROM b UNION ALL SELECT 'latest in b', {ts_sql('max(ts)')} FROM b
UNION ALL SELECT 'from ' || coalesce(sender, 'nobody'), CAST(n AS VARCHAR) FROM (
  SELECT sender, count(*) AS n FROM b GROUP BY sender ORDER BY n DESC, sender NULLS FIRST LIMIT 5)"""
    ),
    "merge_new": over_stores(f"SELECT id, pos FROM a UNION ALL {_NEW}"),
    "merge_new_dedup": over_stores(f"SELECT id, pos FROM a UNION ALL {_FIRST_NEW}"),
    "sync_missing": over_stores("SELECT id, pos FROM a WHERE id NOT IN (SELECT id FROM b)"),
    "skip_known": over_stores(_NEW),
    "reconcile": over_stores(
        f"""SELECT {_ONLY.format('a', 'b')} AS only_in_a, {_ONLY.format('b', 'a')} AS only_in_b,
  {_ONLY.format('a', 'b')} > 0 OR {_ONLY.format('b', 'a')} > 0 AS inconsistent"""
    ),
    "reconcile_digest": over_stores(
        f"""SELECT {_ONLY.format('a', 'b')} AS only_in_a, {_ONLY.format('b', 'a')} AS only_in_b,
  {_ONLY.format('a', 'b')} > 0 OR {_ONLY.format('b', 'a')} > 0 AS inconsistent"""
    ),
    "stored_status": over_stores(
        f"""SELECT 'before' AS moment, count_a, count_b, ids_differing, count_a = count_b AND ids_differing = 0 AS passed,
  CASE WHEN count_a = count_b AND ids_differing = 0 THEN 'completed' ELSE 'completed_with_warnings' END AS status
FROM (SELECT (SELECT count(DISTINCT id) FROM a) AS count_a, (SELECT count(DISTINCT id) FROM b) AS count_b,
  {_ONLY.format('a', 'b')} + {_ONLY.format('b', 'a')} AS ids_differing)
UNION ALL SELECT 'after', count(DISTINCT id), count(DISTINCT id), 0, true, 'completed'
FROM (SELECT id FROM a UNION ALL SELECT id FROM b)"""
    ),
    "verify_gate": over_stores(f"SELECT {_GATE}"),
    "verify_gate_after_sync": over_stores(
        """SELECT count(DISTINCT id) AS count_a, count(DISTINCT id) AS count_b,
  CAST(0 AS BIGINT) AS ids_differing, true AS passed FROM (SELECT id FROM a UNION ALL SELECT id FROM b)"""
    ),
    "set_equality": over_stores(
        f"SELECT {_ONLY.format('a', 'b')} = 0 AND {_ONLY.format('b', 'a')} = 0 AS equal"
    ),
    "union_all": over_stores("SELECT id, pos FROM a UNION ALL SELECT id, pos FROM b"),
    "difference": over_stores(
        """SELECT id, 'a' AS only_in FROM (SELECT id FROM a EXCEPT SELECT id FROM b)
UNION ALL SELECT id, 'b' AS only_in FROM (SELECT id FROM b EXCEPT SELECT id FROM a)"""
    ),
    "distinct_ids": over_mail("SELECT DISTINCT id FROM mail"),
    "ids": over_mail("SELECT id FROM mail"),
    "first_wins": over_mail("SELECT id, min(pos) AS pos FROM mail GROUP BY id"),
    "insertable": over_stores(_FIRST_NEW),
    "load_stats": over_stores(
        f"""SELECT (SELECT count(*) FROM b) AS total_processed, count(*) AS successful,
  CAST(0 AS BIGINT) AS failed, (SELECT count(*) FROM b) - count(*) AS duplicates FROM ({_FIRST_NEW})"""
    ),
    "merge_info": over_stores(
        f"""SELECT (SELECT count(*) FROM a) AS pre_merge_count, (SELECT count(*) FROM b) AS offered_count,
  count(*) AS new_count, (SELECT count(*) FROM a) + count(*) AS post_merge_count FROM ({_NEW})"""
    ),
}
