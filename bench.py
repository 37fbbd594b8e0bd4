"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: cores; BENCH_RUNS: runs per query (the best one counts).
"""

import json
import os
import time

from lodgewise.plans import source_queries  # noqa: F401 - adds its queries
from lodgewise.plans.queries import QUERIES
from lodgewise.session import build_session

HEADLINE = (
    "classify_counts", "feed_classes_corrected", "booking_hotels", "booking_reviews", "geospatial_attractions",
    "explode_array", "json_fields", "union_platforms", "radius_pairs", "radius_pairs_10km", "attraction_density",
    "competitors", "nearest_attraction", "landmarks", "rating_stats", "grouped_rollup", "latest_per_key", "price_idr",
    "outliers", "quantiles", "clean_text", "flatten_scores", "match_entities", "pivot_categories", "sentiment",
    "traveler_mode", "facility_flags", "area_ranks", "market_segments", "calendar", "dq_completeness", "dq_uniqueness",
    "dq_violations", "hotel_attraction_distances", "hotel_features", "review_features", "geospatial_features",
    "radius_read", "rates_by_day",
    "prediction_dataset", "batch_run",
)

ONCE = ("batch_run", "prediction_dataset")  # jobs of many steps


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["classify_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    seconds = {}
    for name in names:
        best = None
        for _ in range(1 if name in ONCE else runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
