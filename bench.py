"""Time every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and is then timed, including the size checks made while planning.
``BENCH_QUERIES`` (comma-separated) limits the run.
"""

import json
import os
import sys
import time
from pathlib import Path

from checks.queries import QUERIES
from claimledger.session import local_session

HEADLINE = ("charge_fact", "encounter_balances", "account_totals")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session("bench", cores, memory=os.environ.get("BENCH_MEMORY", "16g"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        cold = run(name)
        timings[name] = round(run(name), 3)
        print(f"{name:28} first {cold:7.2f}s  then {timings[name]:7.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings[n] for n in HEADLINE if n in timings), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
