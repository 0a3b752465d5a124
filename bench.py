"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs per query, of which the fastest counts (default 2)

Every query is run to its last row and column; nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from mailweir.registry import QUERIES
from mailweir.session import build_session

HEADLINE = (
    "total", "date_range", "top_senders", "daily", "content_stats", "quality_summary", "keywords",
    "null_audit", "dup_ids", "category_share", "sort_recent", "merge_new", "sync_missing",
    "reconcile", "verify_gate", "insertable", "load_stats", "parse_dates", "cutoff",
    "sender_allow", "sender_allow_long", "outcome", "early_stop", "until_stop", "progress",
    "decode_body", "html_unescape", "html_text", "extract_urls", "clean_text", "to_mail_plain",
    "to_mail_html",
)
#: These write and read back whole tables; one run each.
FLOWS = ("write_mail", "load_counts", "ingest_run", "stream_ingest")


def seconds(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "mailweir-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, sf_dir, "total")
    times = {}
    for name in HEADLINE + FLOWS:
        repeat = 1 if name in FLOWS else runs
        times[name] = round(min(seconds(spark, sf_dir, name) for _ in range(repeat)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
