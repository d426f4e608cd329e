"""Seconds per query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, median of ``$BENCH_RUNS`` runs (1); prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

from articlelake.session import session
from articlelake.checks.spark_queries import QUERIES


def main(*names: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("tei_title_mixed")  # start Python workers and load classes
    seconds = {}
    for name in names or QUERIES:
        taken = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            run(name)
            taken.append(time.perf_counter() - start)
        seconds[name] = round(median(taken), 3)
    print(json.dumps({
        "metric": "all queries, median of runs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
