"""Time the headline queries at $BENCH_SF_DIR and print one JSON line.

Each query is planned and run from scratch into the noop sink; the first run warms the JVM and the
best of the following ones counts.
"""

import json
import os
import tempfile
import time

from shelfcast.catalog.queries import QUERIES
from shelfcast.session import get_session
from shelfcast.sources.staging import clear_stages

HEADLINE = (
    "rule_forecast",
    "weekly_label",
    "sku_slide",
    "goodsdaily_granularity",
    "sale_stats_multi_key",
    "global_rank_avg",
    "features_short_slide",
    "features_slide_rank",
    "multi_window_training",
    "day_skeleton_label",
    "ols_week_forecast",
)


def run(query, spark, folder):
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def calibrate(spark):
    """Seconds of a fixed aggregate that no code of this library touches: the machine's yardstick."""
    start = time.perf_counter()
    spark.range(0, 20_000_000, 1, 8).selectExpr("id % 1000 AS k", "sqrt(id) AS v").groupBy("k").agg(
        {"v": "sum"}
    ).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "shelfcast-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
        # Small data on one machine: keep as many tasks as there are cores.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    calibration = min(calibrate(spark) for _ in range(3))
    seconds = {}
    for name in names:
        times = [run(QUERIES[name], spark, folder) for _ in range(repeats)]
        seconds[name] = round(min(times[1:] or times), 3)
        clear_stages(spark)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "calibration": round(calibration, 3),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
