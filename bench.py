"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the cores. Each query runs once to warm up and then BENCH_RUNS times (default 3);
the median counts. Results go to Spark's no-op sink, so every row is computed.

``land_lineitem`` lands the lineitem table, written as CSV files before the clock
starts. ``single_thread`` is the same parse of the same files in one Python process
(``tests/brute.py``: ``csv.reader`` and a loop), the way a driver-side parser works.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from brute import parse  # noqa: E402
from longform import catalog  # noqa: E402
from longform.catalog import inputs  # noqa: E402
from longform.catalog.registry import table  # noqa: E402
from longform.plans.bronze import land_long  # noqa: E402
from longform.sources.storage import scratch_path  # noqa: E402
from longform.sources.tables import write_csv  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [
    "ingest_long",
    "ingest_wide",
    "file_mapping_coverage",
    "detect_header",
    "unpivot_cells",
    "unpivot_columns",
    "silver_standardize",
    "mapping_coverage",
    "canonical_usage",
    "numeric_value",
    "gold_monthly",
    "silver_typed",
    "pivot_back",
    "gold_star",
    "cross_vendor",
    "ingestion_link",
    "null_profile",
    "round_sig_figs",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("longform-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs.messy_files(spark, SF_DIR)
    folder = scratch_path(spark, "bench-lineitem") + "/vendor_a_lineitem.csv"
    write_csv(table(spark, SF_DIR, "lineitem").repartition(int(CPUS)), folder)

    queries = {}
    for name in HEADLINES:
        queries[name] = median_time(lambda: drain(catalog.QUERIES[name](spark, SF_DIR)))
    queries["land_lineitem"] = median_time(lambda: drain(land_long(spark, folder, threshold=5).cells))
    cells = land_long(spark, folder, threshold=5).cells.agg(F.count("*")).first()[0]

    start = time.perf_counter()
    parts = glob.glob(f"{folder.removeprefix('file:')}/*.csv")
    single = sum(len(parse(part, 5)) for part in parts)
    single_thread = round(time.perf_counter() - start, 3) if parts else None
    spark.stop()
    if parts and single != cells:
        raise SystemExit(f"landed {cells} cells, a single thread finds {single}")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "single_thread": {"land_lineitem": single_thread},
                "cells": cells,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
