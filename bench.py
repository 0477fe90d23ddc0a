"""Time the registered queries; prints one JSON line.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list; by
default all but the fits of a hundred trees and more). A query that fails is reported as such and
doesn't stop the others; the exit code then is 1.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lendlens.plans.registry import queries  # noqa: E402
from lendlens.sources.session import local_session  # noqa: E402


#: Fits that run hundreds of passes over the table.
LONG = (
    "fit_gbt_benchmark",
    "fit_gbt_champion",
    "feature_importance",
    "fit_lgd",
    "fit_t_learner",
    "uplift_t_learner",
    "model_roundtrip",
)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    known = queries()
    listed = os.environ.get("BENCH_QUERIES")
    chosen = listed.split(",") if listed else [name for name in known if name not in LONG]
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    known["target_distribution"](spark, sf_dir).collect()  # start the session before timing
    seconds, errors = {}, {}
    for name in chosen:
        started = time.perf_counter()
        try:
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # report it and time the rest
            errors[name] = f"{type(error).__name__}: {str(error)[:300]}"
            print(f"{name} FAILED {errors[name]}", file=sys.stderr, flush=True)
            continue
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = sf_dir.rsplit("sf", 1)[-1]
    found = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
    print(json.dumps(found | ({"errors": errors} if errors else {})))
    return int(bool(errors))


if __name__ == "__main__":
    sys.exit(main())
