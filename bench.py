"""Times the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidewright.plans.queries import QUERIES

HEADLINE = ("gate_daily", "flow_daily", "flow_weekly", "versions_as_of", "input_fingerprint", "change_capture", "upserted_snapshot", "pressure", "curve_change_points", "curve_features", "key_cardinality", "gate_gap_summary", "dwell_times")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["input_fingerprint"](spark, sf_dir).collect()  # starts the executor's threads
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
