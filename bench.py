"""Time the headline queries on $BENCH_SF_DIR with $BENCH_CPUS local cores; print one JSON line."""

from __future__ import annotations

import json
import os
import time

from almoner.plans.registry import queries
from almoner.session import get_session

HEADLINE = (
    "P15_project",
    "T3_page_numbers",
    "J5_campaign_join",
    "J6_merge_column_chunks",
    "A2_donor_metrics",
    "A4_major_gifts",
    "A13_campaign_performance",
    "A22_membership_summary",
    "A30_dimension_counts",
    "A35_donation_program",
    "W1_pareto",
    "W2_annual_retention",
    "R4_segment_summary",
    "R5_growth_scores",
    "R7_opportunity",
    "Q4_fuzzy_join",
    "Q8_combined_join",
    "D5_validate_fields",
    "D9_profile_fields",
    "M6_batch_update",
    "M7_migrate",
    "E6_engagement_score",
    "G2_effective_permissions",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cores}]",
        spark__sql__shuffle__partitions=cores,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, spent = queries(), {}
    # one untimed query starts the JVM's threads and code generation
    known["S1_read_resource"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, one cold run each",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
