"""Wall time of every query at one scale factor; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query writes its whole
result to the no-op sink, so every column of every row is computed. One untimed pass over the
smallest query warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from martloom.session import local_session
from martloom.workloads import QUERIES


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("v1_customers")
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
