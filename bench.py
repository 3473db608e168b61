"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row is produced,
nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkbook.plans.catalog import QUERIES  # noqa: E402
from sparkbook.session import local_session  # noqa: E402

HEADLINE = [
    "q_position_daily",
    "q_valuation",
    "q_carry_forward",
    "q_reconcile",
    "q_snapshot",
    "q_scd2",
    "q_resolve_version",
    "q_one_version",
    "q_asof_rate",
    "q_fx_check",
    "q_running_cash",
    "q_dim_dates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="sparkbook-bench")
    names = [n for n in HEADLINE if n in QUERIES]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in QUERIES]
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["q_movements"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
