"""Benchmark: run the registry queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely through the ``noop`` sink (no driver
collect).  Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

BENCH_QUERIES=all runs every registered query; the default is the headline
set below (one or more per operator family).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "enrich_matches",
    "json_flatten",
    "explode_array",
    "normalize_text",
    "coalesce_group_merge",
    "first_row_per_key",
    "string_agg",
    "merge_upsert",
    "merge_high_water",
    "incremental_versions",
    "incremental_stream",
    "triples_mapping",
    "rdfs_closure",
    "kg_metrics",
    "cluster_top_preference",
    "sample_k_per_key",
    "triple_split_negatives",
    "corpus_keywords",
    "keyword_tagging",
    "vector_search",
    "standardize",
    "dbscan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from zoneflow.plans import registry
    from zoneflow.session import local_session

    registry.load_all()
    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if sel == "all" else (sel.split(",") if sel else HEADLINE)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16), app="zoneflow-bench")
    # Warm-up, not timed: every measured query runs once on the smallest data
    # so JIT / codegen warm-up is not charged to the first query using a path.
    for name in names:
        registry.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
