"""Benchmark the headline queries.

Runs each query to completion (``noop`` sink: full execution, no collect) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line:
{"metric": "headline_total", "value": <sum sec>, "unit": "sec", "queries": {...}, "sf": ...}

``BENCH_QUERIES=all`` times every registered query; a comma list picks some.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helixframe.plans import catalog  # noqa: E402
from helixframe.session import build_session  # noqa: E402

HEADLINE = [
    "run_status", "repair_mate2", "anomaly_audit", "manifest_scan", "filter_samples", "group_by_sample",
    "completion", "pending_dv", "vcf_batches",
    "fastq_scan", "mate_pairs", "fasta_scan",
    "map_reads", "verify_hits", "sorted_alignments", "overlap", "pileup", "genotypes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if sel == "all" else ([s for s in sel.split(",") if s] or HEADLINE)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    # Warm-up on the smallest scale factor next to the bench one (JIT, Python
    # workers), outside the timings.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("run_status", "map_reads", "fastq_scan"):
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
