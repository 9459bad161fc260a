"""Times all queries over the tables in BENCH_SF_DIR and prints one line of JSON.

All queries run once to warm up, then twice more, of which the faster run counts. A time goes
from building the query to its last row; the rows themselves are thrown away.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedloom.plans.queries import queries  # noqa: E402


def run(spark: SparkSession, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedloom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    passes = [
        {name: run(spark, query, sf_dir) for name, query in queries().items()} for _ in range(3)
    ]
    seconds = {name: round(min(p[name] for p in passes[1:]), 3) for name in queries()}
    spark.stop()
    report = {
        "metric": "total of all queries, warm, best of two",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir).removeprefix("sf") or 0),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
