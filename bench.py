"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from facetflow.catalog import QUERIES
from facetflow.session import local_session

HEADLINE = [
    "mispriced",
    "run_growth",
    "run_expansion",
    "gate_status",
    "normalize_listings",
    "listing_keys",
    "dedupe_listings",
    "quality_report",
    "feed_summary",
    "dominant_vendor",
    "title_parse_table",
    "spec_parse_table",
    "measurements",
    "page_links",
    "page_sequence",
    "model_features",
    "category_levels",
    "time_holdout_split",
    "baseline_cv",
    "gram_matrix",
    "cv_metrics",
    "uncertainty_policy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, "bench")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
