"""Headline queries and batch runs on $BENCH_SF_DIR; prints one JSON line."""

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog import QUERIES
from lakerisk.plans.catalog.lake import bronze
from lakerisk.session import build_session
from lakerisk.sources.tables import staged

HEADLINE = [
    "latest_indicators",
    "event_history",
    "dedup_events",
    "feature_matrix",
    "hierarchy_rollup",
    "trend",
    "forecast",
    "label_asof",
    "dominant_factors",
    "kelurahan_factors",
    "priority_rank",
    "priority_rank_scaled",
    "gold_risk",
    "classification_metrics",
    "map_risk",
    "map_page",
    "nearest_units",
    "bbox_join",
    "match_units",
    "summary_totals",
    "upsert_latest",
]


def timed(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def run_query(spark: SparkSession, sf_dir: str, name: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        # The first run compiles the plan, the second one is measured.
        timed(lambda name=name: run_query(spark, sf_dir, name))
        seconds[name] = timed(lambda name=name: run_query(spark, sf_dir, name))
        print(f"{name} {seconds[name]:.2f}s", file=sys.stderr)

    # The runs over 99 % of the log, then a refresh with the last 1 %.
    log, cut = D.survey(spark, sf_dir), "recorded_at > timestamp '2024-01-30 17:00:00'"
    lake = bronze(spark, sf_dir, log.filter(f"not {cut}"))
    newest = staged(spark, log.filter(cut), "newest")
    touched = newest.select("id_wilayah").distinct()
    runs = {
        "run_silver_full": lambda: M.bronze_to_silver(spark, lake),
        "run_train": lambda: M.train(spark, lake),
        "run_gold_full": lambda: M.silver_to_gold(spark, lake),
        "run_silver_incremental": lambda: M.fold_events(spark, lake, newest),
        "run_gold_incremental": lambda: M.silver_to_gold(spark, lake, touched),
    }
    for name, work in runs.items():
        seconds[name] = timed(work)
        print(f"{name} {seconds[name]:.2f}s", file=sys.stderr)

    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
