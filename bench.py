"""Time the batch jobs and headline queries; prints one JSON line.

Stages follow the order of the batch: cleaning, star schema, features, model. The
queries then read the Gold tables the stages have written.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from telcolake.plans import build, star, visuals
from telcolake.sources.shared import fresh_path
from verification import adapter

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    layout = build.Layout(fresh_path(spark, "bench"))
    schema = f"bench_{os.getpid()}"
    bronze = adapter.bronze_tables(spark, SF_DIR)
    timed("build_silver", lambda: build.build_silver(spark, layout, bronze))
    gold = timed("build_gold", lambda: build.build_gold(spark, layout))
    timed("build_features", lambda: build.build_features(spark, layout))
    location = f"{layout.root}/warehouse/{schema}"
    timed("build_model_and_scores", lambda: build.build_scores(spark, layout, schema, location))

    gold_star = star.Star(gold)
    headline = {
        "churn_by_plan": lambda: visuals.churn_by_plan(gold_star),
        "sla_vs_churn": lambda: visuals.sla_vs_churn(gold_star),
        "network_health_by_month": lambda: visuals.network_health_by_month(gold_star),
        "peak_latency_by_region": lambda: visuals.peak_latency_by_region(gold_star),
        "tickets_by_region": lambda: visuals.tickets_by_region(gold_star),
        "payment_failure_and_churn_by_region": lambda: visuals.payment_failure_and_churn_by_region(gold_star),
        "segment_kpis": lambda: visuals.segment_kpis(star.filter_plan(gold_star, ["NBN100", "Fibre"])),
    }
    for name, query in headline.items():
        timed(name, lambda q=query: q().collect())

    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "batch_and_headline_queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
