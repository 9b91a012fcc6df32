"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyfield.catalog import query_functions
from tallyfield.session import build_session

HEADLINE = [
    "read_gzip_csv",
    "parse_fixed_width",
    "element_counts",
    "element_counts_by_array",
    "station_enrichment",
    "join_left_lookup",
    "join_salted",
    "reconcile_station_ids",
    "element_coverage_observed",
    "presence_summary",
    "extract_country_elements",
    "annual_rainfall_cumulative",
    "quality_by_station",
    "furthest_pair_per_country",
    "clean_plays",
    "user_activity",
    "item_popularity",
    "trim_sparse_users_and_items",
    "number_rows_per_user",
    "top_k_per_user",
    "per_user_split",
    "describe_columns",
    "correlation_matrix",
    "area_under_roc",
    "stratified_split_exact",
    "train_lr",
    "train_svm",
    "train_rf",
    "train_gbt",
    "als_recommend_all_users",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    functions = query_functions()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    # One untimed query starts the JVM's code paths.
    functions["annual_rainfall_good_rows"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        functions[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
