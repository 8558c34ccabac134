"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query is planned and run once, written to the noop
sink, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pricewright.plans import catalog
from pricewright.session import local_session

HEADLINE = (
    "top_designers_top_quarter",
    "count_mean_by_photos",
    "condition_distribution",
    "feature_cardinality",
    "price_histogram",
    "price_density_by_department",
    "request_stats",
    "distinct_listings",
    "page_fields",
    "validated_dependent_offers",
    "cleaned_text",
    "exploration_text_stats",
    "top_tail_ngrams",
    "token_overlap",
    "tfidf_cells",
    "description_sentiment",
    "target_mean_codes",
    "ordered_prior_codes",
    "tuning_progress",
    "nearest_vectors",
    "prepared_datasets",
    "experiment_ridge",
    "usage_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("count_mean_by_photos")
    times = {name: run(name) for name in chosen}
    spark.stop()
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus) if cpus.isdigit() else cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
