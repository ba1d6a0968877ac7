"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver). Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "p15_to_marked", "p07_mark_special", "a01_reanchor", "a03_aeda", "a05_n_variants", "a08_random_delete",
    "d03_holdout", "d05_holdout_group_safe", "f01_build_vocab", "f02_encode", "f05_entity_loc_ids",
    "m02_auprc", "m04_compute_metrics", "m09_plateau", "m10_best_step", "i05_submission",
    "e03_column_roles", "e04_describe", "e15_conditional_dist", "e14_group_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from sentrel.plans.queries import QUERIES
    from sentrel.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16)
    # warm-up: JVM, parquet footers
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
