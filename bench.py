"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR`` is the data, ``BENCH_CPUS`` the number of local cores and
``BENCH_RUNS`` the number of timed runs per query after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from carelake import catalog
from carelake.session import local_session


def scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores)

    def timed(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in catalog.QUERIES:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(sf_dir),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
