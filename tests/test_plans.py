"""Shape of the plans: no pairwise joins, no Python, global windows only over small frames."""

import pytest

from almoner.plans.registry import queries

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow")
CHECKED = (
    "P15_project",
    "J5_campaign_join",
    "J6_merge_column_chunks",
    "A4_major_gifts",
    "A13_campaign_performance",
    "A30_dimension_counts",
    "W1_pareto",
    "W2_annual_retention",
    "R4_segment_summary",
    "R5_growth_scores",
    "Q4_fuzzy_join",
    "Q8_combined_join",
    "Q12_accept_field",
    "D5_validate_fields",
    "M6_batch_update",
    "M6_hot_cell",
    "M14_all_pair_report",
    "M14_row_pair_report",
    "M7_migrate",
    "E6_engagement_score",
    "G2_effective_permissions",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_plan_has_no_forbidden_node(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert not [node for node in FORBIDDEN if node in plan]


def test_search_reaches_the_scan(spark):
    plan = plan_of(queries()["L19_nested_rows"](spark, FOLDER))
    assert "EqualTo(l_orderkey,100)" in plan
    assert "l_extendedprice" not in plan


def test_scoring_moves_no_donor_rows(spark):
    from pyspark.sql import functions as F

    from almoner.operators.ranks import quintiles

    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    main = plan_of(quintiles(df, "k", {"s": F.col("v")})).split("Subquery")[0]
    assert "Exchange" not in main


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = plan_of(queries()["A30_dimension_counts"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") >= 2


def test_matching_broadcasts_nothing(spark):
    plan = plan_of(queries()["Q4_fuzzy_join_names"](spark, FOLDER))
    assert "Join" in plan and "Broadcast" not in plan
