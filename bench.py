"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
input and the cores. Every result is computed whole and thrown away. Each query
runs once to warm up and once under the clock; BENCH_WARM=0 skips the first run.
"""

from __future__ import annotations

import json
import logging
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall import checks  # noqa: E402
from rollcall.session import local_session, scratch_run  # noqa: E402

HEADLINE = [
    "snapshot_diff", "priority_merge", "priority_merge_open", "first_wins", "body_md5_dedupe",
    "anti_dedupe", "cross_verify_exact", "containment_match", "name_containment", "tracked_split",
    "upsert_fill", "apply_review", "candidate_enrich", "embedded_payload", "reply_ingest",
    "rank_blocks", "logo_blocks", "timeline_fill", "dim_counts", "topk_per_group", "batches",
    "update_tables", "arena_tables", "digest_rows", "collect_run", "mention_run",
]


def run(spark, name: str, sf: str) -> float:
    with scratch_run(spark):
        start = time.time()
        checks.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.time() - start


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = tempfile.mkdtemp(prefix="rollcall-bench-")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), shared=shared)
    spark.sparkContext.setLogLevel("OFF")
    logging.disable(logging.CRITICAL)
    names = sys.argv[1:] or HEADLINE
    warm = os.environ.get("BENCH_WARM", "1") != "0"
    times = {}
    for name in names:
        if warm:
            run(spark, name, sf)
        times[name] = round(run(spark, name, sf), 3)
        print(name, times[name], file=sys.stderr)
    scale = re.search(r"sf([\d.]+)", sf)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
