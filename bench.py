"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once untimed, then three times; the median counts.  Tables of one file and
one row group cannot be split by a scan, so the text tables are first copied, untimed, to
as many files as there are cores, as a snapshot of real size would have.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

SPLIT = ("documents", "events", "pages")
HEADLINE = [
    "clean_text", "section_extract", "reference_urls", "paywall_strip", "js_redirect_flag",
    "url_domain", "route_urls", "route_by_rules", "explode_sources", "fetch_status",
    "page_headings", "page_text", "page_title", "page_body", "archive_body", "selector_profile",
    "anchor_links", "article_ids", "article_table", "content_table", "entry_counts",
    "resume_pending", "seed_lookup", "claim_evidence_pairs", "label_counts", "field_completeness",
    "date_range", "reference_stats",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from factloom.session import local_session
    from suite.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    copy = tempfile.mkdtemp(prefix="bench-")
    rows = {}
    for table in sorted(os.listdir(sf_dir)):
        name = table.removesuffix(".parquet")
        if name in SPLIT:
            spark.read.parquet(f"{sf_dir}/{table}").repartition(int(cpus)).write.parquet(f"{copy}/{table}")
            rows[name] = spark.read.parquet(f"{copy}/{table}").count()
        else:
            os.symlink(os.path.join(os.path.abspath(sf_dir), table), f"{copy}/{table}")

    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, copy).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "table_rows": rows, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
