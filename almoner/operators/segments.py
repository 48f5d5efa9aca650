"""RFM metrics, segments, growth scores and threshold rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.functions.scalars import bucket, days_between, days_since
from almoner.operators.aggregates import mean_of, money, rows, share_of_total
from almoner.operators.ranks import attach, exact_quantiles, quintiles, robust_scores
from almoner.session import materialize


def rfm_metrics(gifts: DataFrame, as_of: datetime) -> DataFrame:
    """Recency, frequency and money per donor; the deviation of a single gift is 0."""
    amount = F.col("amount")
    grouped = gifts.groupBy("account_id").agg(
        F.max("date").alias("last_gift"),
        F.count("donation_id").alias("frequency"),
        money(amount).alias("total_donated"),
        mean_of(amount).alias("avg_donation"),
        F.coalesce(F.stddev_samp(amount.cast("double")), F.lit(0.0)).alias("donation_std"),
        F.min(amount).cast("double").alias("min_donation"),
        F.max(amount).cast("double").alias("max_donation"),
        F.min("date").alias("first_gift"),
    )
    return grouped.withColumn("recency_days", days_since(F.col("last_gift"), as_of)).withColumn(
        "tenure_days", days_between(F.col("last_gift"), F.col("first_gift"))
    )


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """1-5 scores by first-come rank (recency reversed) and their joined code.

    The metrics are materialized once: the ranking and the scoring both read them.
    """
    scored = quintiles(
        materialize(rfm),
        "account_id",
        {
            "r_score": F.col("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("total_donated"),
        },
        reverse=["r_score"],
    )
    digits = [F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]
    return scored.withColumn("rfm_score", F.concat(*digits))


def rfm_segment(scored: DataFrame) -> DataFrame:
    """Segment name by the first rule that holds."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    rules = [
        ("Champions", (r >= 4) & (f >= 4) & (m >= 4)),
        ("Loyal Customers", (r >= 3) & (f >= 3) & (m >= 3)),
        ("New Customers", (r >= 4) & (f <= 2)),
        ("Potential Loyalists", (r >= 3) & (f >= 3) & (m <= 2)),
        ("Promising", (r >= 3) & (f <= 2) & (m <= 2)),
        ("At Risk", (r <= 2) & (f >= 4) & (m >= 4)),
        ("Cannot Lose Them", (r <= 2) & (f >= 2) & (m >= 2)),
        ("Hibernating", (r <= 2) & (f <= 2) & (m >= 3)),
    ]
    return scored.withColumn("segment", bucket(r, [(t, n) for n, t in rules]).otherwise("Lost"))


def segment_summary(segmented: DataFrame, by: str = "segment") -> DataFrame:
    grouped = segmented.groupBy(by).agg(
        rows().alias("donors"),
        money(F.col("total_donated").cast("decimal(28,2)")).alias("revenue"),
        F.avg("avg_donation").alias("avg_gift"),
        mean_of(F.col("frequency")).alias("avg_frequency"),
        mean_of(F.col("recency_days")).alias("avg_recency"),
    )
    return share_of_total(grouped, "revenue", "revenue_share")


def rfm_segments(gifts: DataFrame, as_of: datetime) -> DataFrame:
    """Gifts to segmented donors in one go."""
    return rfm_segment(rfm_scores(rfm_metrics(gifts, as_of)))


def growth_scores(rfm: DataFrame) -> DataFrame:
    """Frequency, recency and consistency scores and the weighted upgrade potential."""
    consistency = F.coalesce(F.try_divide(F.col("donation_std"), F.col("avg_donation")), F.lit(0.0))
    # rounded far below any meaningful digit, so that ties do not hang on summation order
    base = materialize(rfm.withColumn("gift_consistency", F.round(consistency, 9)))
    scored = robust_scores(
        base,
        {
            "frequency_score": (F.col("frequency"), True),
            "recency_score": (F.col("recency_days"), False),
            "consistency_score": (F.col("gift_consistency"), False),
        },
    )
    potential = (
        F.col("frequency_score") * 0.4 + F.col("recency_score") * 0.4 + F.col("consistency_score") * 0.2
    )
    return scored.withColumn("upgrade_potential", potential)


def capacity_ratio(rfm: DataFrame) -> DataFrame:
    return rfm.withColumn("capacity_ratio", F.try_divide(F.col("avg_donation"), F.col("max_donation")))


def opportunity(rfm: DataFrame) -> DataFrame:
    """Opportunity category by the first rule that holds; lapsed donors split at the median total."""
    base = capacity_ratio(materialize(rfm))
    held = attach(base, exact_quantiles(base, {"median": (F.col("total_donated"), 0.5)}), "__q")
    recency, gifts = F.col("recency_days"), F.col("frequency")
    recent = (recency <= 90) & (gifts >= 3)
    lapsed = recency > 365
    above = F.col("total_donated") > F.col("__q")["median"]
    category = (
        F.when(recent & (F.col("capacity_ratio") < 0.7), "High-Potential Upgrade")
        .when(recent, "Loyal Donor - Sustain")
        .when((recency <= 365) & (gifts >= 2), "Mid-Level Cultivation")
        .when(F.col("max_donation") > F.col("avg_donation") * 2, "Capacity Upgrade Prospect")
        .when(lapsed & above, "Reactivation Priority")
        .when(lapsed, "Reactivation Standard")
        .otherwise("Standard Cultivation")
    )
    return held.withColumn("opportunity_category", category).drop("__q")


def growth_trend(df: DataFrame) -> DataFrame:
    g = F.col("yoy_growth")
    label = bucket(
        g,
        [
            (g <= -0.5, "Declining"),
            (g <= -0.1, "Slight Decline"),
            (g <= 0.1, "Stable"),
            (g <= 0.5, "Growing"),
            (g > 0.5, "Rapid Growth"),
        ],
    )
    return df.withColumn("growth_trend", label)


def opportunity_summary(growth: DataFrame) -> DataFrame:
    grouped = growth.groupBy("opportunity_category").agg(
        rows().alias("donors"),
        money(F.col("total_donated").cast("decimal(28,2)")).alias("revenue"),
        F.avg("avg_donation").alias("avg_gift"),
        F.avg("upgrade_potential").alias("avg_upgrade_potential"),
        mean_of(F.col("recency_days")).alias("avg_recency"),
    )
    return share_of_total(grouped, "revenue", "revenue_share")


def high_potential(growth: DataFrame) -> DataFrame:
    return growth.where((F.col("upgrade_potential") >= 4) & (F.col("recency_days") <= 365)).orderBy(
        F.desc("upgrade_potential"), F.desc("total_donated"), "account_id"
    )


def tenure_category(rfm: DataFrame) -> DataFrame:
    """Tenure label; no label for a tenure of 0 days."""
    d = F.col("tenure_days")
    label = bucket(
        d,
        [
            ((d > 0) & (d <= 365), "<1 year"),
            ((d > 365) & (d <= 730), "1-2 years"),
            ((d > 730) & (d <= 1095), "2-3 years"),
            ((d > 1095) & (d <= 1825), "3-5 years"),
            ((d > 1825) & (d <= 3650), "5-10 years"),
            (d > 3650, "10+ years"),
        ],
    )
    return rfm.withColumn("tenure_category", label)


# Advice thresholds as (area, priority, metric, above, at_least, below).
RULES = (
    ("Donor Retention", "HIGH", "retention_rate", None, None, 50.0),
    ("Revenue Diversification", "MEDIUM", "major_share", 60.0, None, None),
    ("Donor Development", "HIGH", "repeat_rate", None, None, 40.0),
    ("Reactivation", "MEDIUM", "lapsed_share", 30.0, None, None),
    ("Geographic Expansion", "LOW", "top_state_share", 70.0, None, None),
    ("Gift Frequency", "MEDIUM", "avg_gifts", None, None, 2.5),
    ("Low Opportunity Engagement", "HIGH", "opportunity_rate", None, None, 30.0),
    ("Opportunity Engagement", "MEDIUM", "opportunity_rate", None, 30.0, 60.0),
    ("Strong Opportunity Engagement", "STRENGTH", "opportunity_rate", None, 60.0, None),
    ("Group Organization", "MEDIUM", "group_rate", None, None, 40.0),
    ("Volunteer Recruitment", "GROWTH", "total_volunteers", None, None, 50.0),
    ("Low Opportunity Assignment", "ATTENTION", "avg_opportunities", None, None, 1.5),
    ("Geographic Diversity", "STRENGTH", "states", 3.0, None, None),
    ("Limited Group Structure", "ORGANIZATION", "groups", None, None, 3.0),
    ("Low Program Utilization", "HIGH", "utilisation", None, None, 60.0),
    ("Donation Optimization", "GROWTH", "avg_gift", None, None, 100.0),
    ("Cross-Program Development", "OPPORTUNITY", "donor_percentage", None, None, 25.0),
    ("Member Conversion", "HIGH", "member_non_donors", 0.0, None, None),
    ("Volunteer Appreciation", "MEDIUM", "volunteer_non_donors", 0.0, None, None),
    ("Event Follow-up", "MEDIUM", "event_non_donors", 0.0, None, None),
)
RULE_SCHEMA = "area string, priority string, metric string, above double, at_least double, below double"
# Segments and opportunity categories that call for an action.
SEGMENT_ACTIONS = (
    ("Champions", "HIGH", "VIP Stewardship Program"),
    ("At Risk", "HIGH", "Urgent Retention Campaign"),
    ("New Customers", "MEDIUM", "New Donor Journey"),
    ("High-Potential Upgrade", "HIGH", "Capacity Building Campaign"),
    ("Reactivation Priority", "MEDIUM", "Win-Back Campaign"),
)


def rule_table(kpi: DataFrame, rules=RULES) -> DataFrame:
    return kpi.sparkSession.createDataFrame(list(rules), RULE_SCHEMA)


def apply_rules(kpi: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules whose threshold a one-row frame of metrics passes, with the metric's value."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in kpi.columns]
    )
    value = F.col("value")
    passes = (
        F.coalesce(value > F.col("above"), F.lit(True))
        & F.coalesce(value >= F.col("at_least"), F.lit(True))
        & F.coalesce(value < F.col("below"), F.lit(True))
    )
    # the other side is one row per metric of a one-row frame
    long = kpi.select(F.inline(pairs)).where(value.isNotNull())
    return rules.join(long, "metric").where(passes).select("area", "priority", "metric", "value")


def segment_actions(summary: DataFrame, by: str = "segment") -> DataFrame:
    """Summary rows of the segments that call for an action."""
    actions = summary.sparkSession.createDataFrame(
        list(SEGMENT_ACTIONS), f"{by} string, priority string, strategy string"
    )
    return summary.join(actions, by)


def health_bands(kpi: DataFrame) -> DataFrame:
    """Three-step bands for the metrics present in a KPI row."""
    bands = {
        "utilisation": (60, 40, "Strong", "Moderate", "Needs Attention"),
        "donor_percentage": (25, 10, "strong", "moderate", "limited"),
        "opportunity_rate": (60, 30, "strong", "moderate", "low"),
        "groups": (5, 2, "strong", "moderate", "low"),
        "states": (5, 2, "strong", "moderate", "low"),
    }
    out = kpi
    for metric, (high, middle, top, mid, low) in bands.items():
        if metric in kpi.columns:
            c = F.col(metric)
            band = F.when(c > high, top).when(c > middle, mid).otherwise(low)
            out = out.withColumn(f"{metric}_band", band)
    return out
