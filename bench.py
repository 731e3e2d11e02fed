"""Time the load of each warehouse table and every registered query; print one JSON line.

BENCH_SF_DIR: folder of the order-processing tables; BENCH_CPUS: local threads. Results go to the noop sink, so a query's
time is that of all its rows. The load steps come first: reports then read stored tables, as they do in use.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from quaystar.plans.catalogue import QUERIES, STORED_STAGING, warehouse
from quaystar.plans.warehouse import STEPS
from quaystar.session import local_session


def run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).selectExpr("sum(id)"))
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    wh = warehouse(spark, folder)
    for table in sorted(STORED_STAGING):
        timed(f"load_{table}", lambda: wh.table(table))
    for step in STEPS:
        timed(f"load_{step.table}", lambda: wh.build(step.table))
    for name, query in QUERIES.items():
        timed(name, lambda: run(query(spark, folder)))
    result = {
        "metric": "total time of the table loads and all registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
