"""Time the headline queries over BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from jangbu.plans.catalog import QUERIES
from jangbu.session import local_session, scratch

HEADLINE = [
    "vol_district",
    "vol_category_month",
    "vol_grouping_sets",
    "vol_item_year",
    "zero_ratio_by_item",
    "impute_zero_year_median",
    "item_quartiles",
    "iqr_by_item",
    "iqr_by_group_approx",
    "iqr_removed_counts",
    "price_summary",
    "distinct_profile",
    "item_profile",
    "parse_year_month",
    "assign_category",
    "head_slice",
    "dedup_first",
    "tfidf_match",
    "tfidf_documents",
    "survey_report",
    "survey_report_clean",
    "item_report",
]


def seconds(spark, name: str, folder: str) -> float:
    with scratch(spark):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "vol_district", folder)  # starts the executors and reads the footers once
    timed = {name: seconds(spark, name, folder) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
