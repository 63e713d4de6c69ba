"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the cores. Every query runs
once unmeasured, then the faster of two runs counts; results are produced in full and
thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import workload.all_queries  # noqa: E402,F401
from ledgerloom.session import local_session  # noqa: E402
from workload.registry import SPARK  # noqa: E402

HEADLINE = [
    "monthly_sales", "top3_per_category", "text_contains", "domain_search", "orders_by_status", "inventory_apply",
    "audit_range", "audit_by_actor", "clean_text", "dedupe_exact", "capped_payments", "overpaid", "dup_members",
    "gen_order_items", "gen_order_history", "surrogate_keys", "conform_invoices", "conform_payments", "quality_by_action",
    "findings",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in wanted:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            SPARK[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else folder}))
    spark.stop()


if __name__ == "__main__":
    main()
