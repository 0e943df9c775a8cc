"""Benchmark the headline jobs at one scale factor; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each job is forced to completion with a ``noop`` write (full computation,
no collect to the driver).  One untimed pass over sf0.001 warms the JVM
first.  Reports run against the stored master (checkpointed once, timed
as its own job), as a deployment would.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from custfold.catalog import REGISTRY, load_all  # noqa: E402
from custfold.plans import pipeline  # noqa: E402
from custfold.session import get_spark  # noqa: E402

HEADLINE = {
    "ingest_pos": ["upsert_pos_customers"],
    "classify_email": ["classify_email"],
    "rebuild_master": ["rebuild_pipeline"],
    "refresh_master": ["refresh_master"],
    "refresh_counts": ["refresh_counts_incremental"],
    "push_queue": ["pending_queue", "build_payloads", "push_plan"],
    "push_outcomes": ["push_outcome_create", "push_outcome_update", "record_push_state"],
    "reports": ["master_summary", "quality_totals", "consent_by_brand", "push_by_brand", "segment_counts",
                "tag_distribution", "preflight_summary", "pipeline_overview", "possible_duplicates"],
    "signup_stream": ["signup_stream"],
}


def _run(spark, names, sf_dir):
    for n in names:
        REGISTRY[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    load_all()
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for names in HEADLINE.values():
            _run(spark, names, warm)
    times = {}
    t = time.time()
    pipeline.stored_master(spark, sf_dir)
    pipeline.stored_sources(spark, sf_dir)
    times["store_master"] = round(time.time() - t, 3)
    for key, names in HEADLINE.items():
        t = time.time()
        _run(spark, names, sf_dir)
        times[key] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
