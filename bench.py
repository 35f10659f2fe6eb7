"""Times the headline queries: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS``.

One warm-up, then the median of the runs. Results are computed in full and thrown away (``noop``).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlens.queries import QUERIES  # noqa: E402

HEADLINES = (
    "top_games",
    "top_games_dated",
    "top_games_summary",
    "top_authors_by_count",
    "top_authors_by_upvotes",
    "engagement_all",
    "clean_cast",
    "null_audit",
    "drop_incomplete",
    "drop_report",
    "null_or_zero_counts",
    "column_profile",
    "column_profile_sketch",
    "value_frequency",
    "distinct_games",
    "game_summary_all",
    "daily_counts_sales",
    "acquisition_split",
    "top_upvoted",
    "top_funny",
    "top_commented",
    "sentiment_scores_all",
    "sentiment_overall",
    "sentiment_positive",
    "sentiment_histogram",
    "sentiment_plugin",
    "game_report",
    "parquet_roundtrip",
    "csv_roundtrip",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - start
    spark.catalog.clearCache()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timings = {}
    for name in sys.argv[1:] or HEADLINES:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
