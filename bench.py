"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is run to the end into the no-op sink, so nothing is pruned and
nothing is shipped to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from reviewmill.plans import catalog
from reviewmill.session import build_session, drop_intermediate

HEADLINE = (
    "top_products_by_category",
    "clean_reviews",
    "enrich_reviews",
    "build_features",
    "feature_store",
    "simple_monitor",
    "quality_validation",
    "iqr_outliers",
    "drift_report",
    "percentile_ranks",
    "user_rolling",
    "product_rolling",
    "dedup_reviews",
    "latest_per_user",
    "user_rollup",
    "join_popular",
    "correlation_matrix",
    "temporal_summary",
    "baseline_predict",
    "ranking_metrics",
    "index_ids",
    "similar_items",
    "ab_t_test",
    "ab_mann_whitney",
    "stream_ab_metrics",
    "similar_users",
    "user_knn",
    "etl_job",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    chosen = sys.argv[1:] or HEADLINE
    # The first job pays for JVM warm-up; it is not part of any query.
    queries["rating_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in chosen:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]} s", file=sys.stderr)
        drop_intermediate(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
