"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set). Each query runs to completion
through the ``noop`` sink (full execution, nothing collected). ``vendor_run`` is the
production path: one whole delivery from JSON lines into a fresh store, next to a stable
set that is there already. Before the clock, every query runs once on the smallest scale
(JIT and codegen caches); nothing of the measured scale is touched.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from taxorule.plans.binding_plan import QUERIES  # noqa: E402
from taxorule.plans.pipeline import IMPORT_TS, run_vendor  # noqa: E402
from taxorule.session import build_session  # noqa: E402
from taxorule.sources import driver_tables as dt  # noqa: E402
from taxorule.sources.match import match_products  # noqa: E402
from taxorule.sources.store import SnapshotStore  # noqa: E402

HEADLINE = ("scored_candidates", "scored_candidates_by_role", "rule_proposals", "rule_changes", "keyword_stats",
            "vendor_inside", "previous_pairs", "stable_merge", "vendor_match_products", "vendor_run")


def seeded_store(spark, sf_dir: str) -> str:
    """A store that holds the other vendor's records (not part of a run's time)."""
    root = os.path.join(tempfile.mkdtemp(prefix="taxorule-bench-", dir="/tmp"), "store")
    SnapshotStore(spark, root).write_stable(dt.existing_training(spark, sf_dir), IMPORT_TS)
    return root


def run(spark, name: str, sf_dir: str) -> float:
    root = seeded_store(spark, sf_dir) if name == "vendor_run" else None
    began = time.perf_counter()
    if root:
        run_vendor(spark, root, None, dt.RUN_VENDOR, products=match_products(dt.match_document_lines(spark, sf_dir)))
    else:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app_name="taxorule-bench", shuffle_partitions=cpus,
                          extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            run(spark, name, warm_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
