"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma
list) narrows the run.  Each query is run once to the end, into a sink that
keeps nothing.  The derived inputs are written before the clock starts; their
time is reported apart.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog import fixtures
from catalog.queries import QUERIES, classified
from dirsync.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    for name in fixtures.FIXTURES:
        fixtures.load(spark, sf_dir, name)
    classified(spark, sf_dir)
    setup = time.perf_counter() - start

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in wanted or QUERIES:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as err:  # noqa: BLE001
            failed[name] = str(err)[:200]
            continue
        times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total time of the registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup_sec": round(setup, 3),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
