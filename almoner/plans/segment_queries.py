"""Queries on RFM segments, growth, rules and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import aggregates as A
from almoner.operators import cluster as K
from almoner.operators import segments as R
from almoner.operators import series as W
from almoner.operators.ranks import attach
from almoner.plans.aggregate_queries import YOY
from almoner.plans.registry import query, rounded
from almoner.plans.standins import AS_OF
from almoner.session import materialize

SCORED = """WITH ranked AS (SELECT *, row_number() OVER (ORDER BY recency_days, account_id) - 1 AS a, row_number() OVER (ORDER BY frequency, account_id) - 1 AS b,
  row_number() OVER (ORDER BY total_donated, account_id) - 1 AS c, count(*) OVER () - 1 AS n FROM rfm),
scored AS (SELECT *, CAST(6 - greatest(1, (5 * a + n - 1) // n) AS INTEGER) AS r_score, CAST(greatest(1, (5 * b + n - 1) // n) AS INTEGER) AS f_score,
  CAST(greatest(1, (5 * c + n - 1) // n) AS INTEGER) AS m_score FROM ranked),
seg AS (SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
  WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers' WHEN r_score >= 3 AND f_score >= 3 AND m_score <= 2 THEN 'Potential Loyalists'
  WHEN r_score >= 3 AND f_score <= 2 AND m_score <= 2 THEN 'Promising' WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk'
  WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 2 THEN 'Cannot Lose Them' WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 3 THEN 'Hibernating' ELSE 'Lost' END AS segment FROM scored),
summary AS (SELECT segment, count(*) AS donors, CAST(sum(CAST(total_donated AS DECIMAL(28,2))) AS DOUBLE) AS revenue, round(avg(avg_donation), 4) AS avg_gift,
  CAST(sum(frequency) AS DOUBLE) / count(*) AS avg_frequency, CAST(sum(recency_days) AS DOUBLE) / count(*) AS avg_recency FROM seg GROUP BY segment)
"""
GROWTH = """WITH g0 AS (SELECT *, round(coalesce(CASE WHEN avg_donation <> 0 THEN donation_std / avg_donation END, 0.0), 9) AS gift_consistency FROM rfm),
g1 AS (SELECT *, count(*) OVER () AS n, rank() OVER (ORDER BY frequency) + (count(*) OVER (PARTITION BY frequency) - 1) / 2.0 AS avg_rank FROM g0),
edges AS (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(gift_consistency, [0.2, 0.4, 0.6, 0.8]) AS c FROM g0),
g2 AS (SELECT g1.*, CAST(ceil(5 * avg_rank / n) AS DOUBLE) AS frequency_score,
  CASE WHEN recency_days <= r[1] THEN 5.0::DOUBLE WHEN recency_days <= r[2] THEN 4.0 WHEN recency_days <= r[3] THEN 3.0 WHEN recency_days <= r[4] THEN 2.0 ELSE 1.0 END AS recency_score,
  CASE WHEN gift_consistency <= c[1] THEN 5.0::DOUBLE WHEN gift_consistency <= c[2] THEN 4.0 WHEN gift_consistency <= c[3] THEN 3.0 WHEN gift_consistency <= c[4] THEN 2.0 ELSE 1.0 END AS consistency_score
  FROM g1, edges),
growth AS (SELECT *, round(frequency_score * 0.4::DOUBLE + recency_score * 0.4::DOUBLE + consistency_score * 0.2::DOUBLE, 6) AS upgrade_potential FROM g2),
opp AS (SELECT *, avg_donation / max_donation AS capacity_ratio,
  CASE WHEN recency_days <= 90 AND frequency >= 3 THEN CASE WHEN avg_donation / max_donation < 0.7 THEN 'High-Potential Upgrade' ELSE 'Loyal Donor - Sustain' END
    WHEN recency_days <= 365 AND frequency >= 2 THEN 'Mid-Level Cultivation' WHEN max_donation > avg_donation * 2 THEN 'Capacity Upgrade Prospect'
    WHEN recency_days > 365 THEN CASE WHEN total_donated > (SELECT quantile_cont(total_donated, 0.5) FROM rfm) THEN 'Reactivation Priority' ELSE 'Reactivation Standard' END
    ELSE 'Standard Cultivation' END AS opportunity_category FROM growth),
opp_summary AS (SELECT opportunity_category, count(*) AS donors, CAST(sum(CAST(total_donated AS DECIMAL(28,2))) AS DOUBLE) AS revenue, round(avg(avg_donation), 4) AS avg_gift,
  round(avg(upgrade_potential), 4) AS avg_upgrade_potential, CAST(sum(recency_days) AS DOUBLE) / count(*) AS avg_recency FROM opp GROUP BY 1)
"""


@query(
    "R1_rfm_metrics",
    """SELECT account_id, last_gift, first_gift, frequency, total_donated, avg_donation, round(donation_std, 4) AS donation_std,
      min_donation, max_donation, recency_days, tenure_days FROM rfm""",
)
def _(crm):
    return rounded(crm.rfm, "donation_std", digits=4)


@query("R2_rfm_scores", SCORED + "SELECT account_id, r_score, f_score, m_score, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score FROM scored")
def _(crm):
    return R.rfm_scores(crm.rfm).select("account_id", "r_score", "f_score", "m_score", "rfm_score")


@query("R3_rfm_segment", SCORED + "SELECT account_id, segment FROM seg")
def _(crm):
    return R.rfm_segments(crm.gifts, AS_OF).select("account_id", "segment")


def segment_report(crm):
    summary = R.segment_summary(R.rfm_segments(crm.gifts, AS_OF))
    return rounded(rounded(summary, "avg_gift", digits=4), "revenue_share")


@query("R4_segment_summary", SCORED + "SELECT *, round(revenue / (SELECT sum(revenue) FROM summary) * 100.0, 6) AS revenue_share FROM summary")
def _(crm):
    return segment_report(crm)


def _growth(crm):
    return rounded(R.growth_scores(crm.rfm), "upgrade_potential")


@query("R5_growth_scores", GROWTH + "SELECT account_id, frequency_score, recency_score, consistency_score, upgrade_potential FROM growth")
def _(crm):
    return _growth(crm).select("account_id", "frequency_score", "recency_score", "consistency_score", "upgrade_potential")


@query("R6_capacity_ratio", "SELECT account_id, round(avg_donation / max_donation, 9) AS capacity_ratio FROM rfm")
def _(crm):
    return rounded(R.capacity_ratio(crm.rfm), "capacity_ratio", digits=9).select("account_id", "capacity_ratio")


@query("R7_opportunity", GROWTH + "SELECT account_id, opportunity_category FROM opp")
def _(crm):
    return R.opportunity(crm.rfm).select("account_id", "opportunity_category")


@query(
    "R8_growth_trend",
    YOY
    + """SELECT account_id, CASE WHEN yoy_growth <= -0.5 THEN 'Declining' WHEN yoy_growth <= -0.1 THEN 'Slight Decline' WHEN yoy_growth <= 0.1 THEN 'Stable'
      WHEN yoy_growth <= 0.5 THEN 'Growing' ELSE 'Rapid Growth' END AS growth_trend FROM yoy""",
)
def _(crm):
    return R.growth_trend(W.yoy(crm.donations, AS_OF)).select("account_id", "growth_trend")


@query(
    "R9_opportunity_summary",
    GROWTH + "SELECT *, round(revenue / (SELECT sum(revenue) FROM opp_summary) * 100.0, 6) AS revenue_share FROM opp_summary",
)
def _(crm):
    summary = R.opportunity_summary(R.opportunity(_growth(crm)))
    return rounded(rounded(summary, "avg_gift", "avg_upgrade_potential", digits=4), "revenue_share")


@query("R9_high_potential", GROWTH + "SELECT account_id, upgrade_potential, total_donated FROM growth WHERE upgrade_potential >= 4 AND recency_days <= 365")
def _(crm):
    return R.high_potential(_growth(crm)).select("account_id", "upgrade_potential", "total_donated")


@query(
    "R10_tenure_category",
    """SELECT CASE WHEN t > 3650 THEN '10+ years' WHEN t > 1825 THEN '5-10 years' WHEN t > 1095 THEN '3-5 years' WHEN t > 730 THEN '2-3 years'
      WHEN t > 365 THEN '1-2 years' WHEN t > 0 THEN '<1 year' END AS tenure_category, count(*) AS donors FROM (SELECT tenure_days AS t FROM rfm) GROUP BY 1""",
)
def _(crm):
    return R.tenure_category(crm.rfm).groupBy("tenure_category").agg(F.count("*").alias("donors"))


KPI = """WITH recent AS (SELECT account_id IN (SELECT account_id FROM donations WHERE date >= TIMESTAMP '2001-01-01') AS d FROM accounts),
kpi AS (SELECT
  (SELECT CAST(count(*) FILTER (WHERE frequency > 1) AS DOUBLE) / count(*) * 100.0 FROM rfm) AS repeat_rate,
  (SELECT CAST(sum(frequency) AS DOUBLE) / count(*) FROM rfm) AS avg_gifts,
  (SELECT CAST(count(*) FILTER (WHERE recency_days > 365) AS DOUBLE) / count(*) * 100.0 FROM rfm) AS lapsed_share,
  (SELECT CAST(count(*) FILTER (WHERE d) AS DOUBLE) / count(*) * 100.0 FROM recent) AS donor_percentage,
  (SELECT CAST(count(*) FILTER (WHERE assigned_opportunities IS NOT NULL) AS DOUBLE) / count(*) * 100.0 FROM volunteers) AS opportunity_rate,
  (SELECT count(DISTINCT state) FROM accounts) AS states, (SELECT count(DISTINCT volunteer_group) FROM volunteers) AS groups)
"""


def _kpi(crm):
    metrics = A.donor_metrics(crm.gifts, AS_OF)
    recent = crm.donations.where(F.col("date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    volunteers = crm.volunteers.withColumnRenamed("kind", "account_type")
    return (
        A.giving_frequency(metrics)
        .select("repeat_rate", "avg_gifts")
        .withColumns(
            {
                "lapsed_share": A.lapsed_share(metrics).select("lapsed_share").scalar(),
                "donor_percentage": A.donor_percentage(crm.accounts, recent).select("donor_percentage").scalar(),
                "opportunity_rate": A.volunteer_kpis(volunteers).select("opportunity_rate").scalar(),
                "states": crm.accounts.agg(F.count_distinct("state")).scalar(),
                "groups": crm.volunteers.agg(F.count_distinct("volunteer_group")).scalar(),
            }
        )
    )


# The rules, written out again on this side.
RULES_SQL = """
  ('Donor Retention', 'HIGH', 'retention_rate', NULL, NULL, 50.0::DOUBLE),
  ('Revenue Diversification', 'MEDIUM', 'major_share', 60.0::DOUBLE, NULL, NULL),
  ('Donor Development', 'HIGH', 'repeat_rate', NULL, NULL, 40.0::DOUBLE),
  ('Reactivation', 'MEDIUM', 'lapsed_share', 30.0::DOUBLE, NULL, NULL),
  ('Geographic Expansion', 'LOW', 'top_state_share', 70.0::DOUBLE, NULL, NULL),
  ('Gift Frequency', 'MEDIUM', 'avg_gifts', NULL, NULL, 2.5::DOUBLE),
  ('Low Opportunity Engagement', 'HIGH', 'opportunity_rate', NULL, NULL, 30.0::DOUBLE),
  ('Opportunity Engagement', 'MEDIUM', 'opportunity_rate', NULL, 30.0::DOUBLE, 60.0::DOUBLE),
  ('Strong Opportunity Engagement', 'STRENGTH', 'opportunity_rate', NULL, 60.0::DOUBLE, NULL),
  ('Group Organization', 'MEDIUM', 'group_rate', NULL, NULL, 40.0::DOUBLE),
  ('Volunteer Recruitment', 'GROWTH', 'total_volunteers', NULL, NULL, 50.0::DOUBLE),
  ('Low Opportunity Assignment', 'ATTENTION', 'avg_opportunities', NULL, NULL, 1.5::DOUBLE),
  ('Geographic Diversity', 'STRENGTH', 'states', 3.0::DOUBLE, NULL, NULL),
  ('Limited Group Structure', 'ORGANIZATION', 'groups', NULL, NULL, 3.0::DOUBLE),
  ('Low Program Utilization', 'HIGH', 'utilisation', NULL, NULL, 60.0::DOUBLE),
  ('Donation Optimization', 'GROWTH', 'avg_gift', NULL, NULL, 100.0::DOUBLE),
  ('Cross-Program Development', 'OPPORTUNITY', 'donor_percentage', NULL, NULL, 25.0::DOUBLE),
  ('Member Conversion', 'HIGH', 'member_non_donors', 0.0::DOUBLE, NULL, NULL),
  ('Volunteer Appreciation', 'MEDIUM', 'volunteer_non_donors', 0.0::DOUBLE, NULL, NULL),
  ('Event Follow-up', 'MEDIUM', 'event_non_donors', 0.0::DOUBLE, NULL, NULL)"""


@query(
    "R11_apply_rules",
    KPI
    + f""", rules(area, priority, metric, above, at_least, below) AS (VALUES {RULES_SQL}),
    long AS (UNPIVOT (SELECT repeat_rate, avg_gifts, lapsed_share, donor_percentage, opportunity_rate, states::DOUBLE AS states, groups::DOUBLE AS groups FROM kpi)
      ON COLUMNS(*) INTO NAME metric VALUE value)
    SELECT area, priority, rules.metric, value FROM rules JOIN long ON long.metric = rules.metric
    WHERE (above IS NULL OR value > above) AND (at_least IS NULL OR value >= at_least) AND (below IS NULL OR value < below)""",
)
def _(crm):
    kpi = _kpi(crm)
    return R.apply_rules(kpi, R.rule_table(kpi))


@query(
    "R11_segment_actions",
    SCORED
    + """SELECT segment, donors, revenue, CASE segment WHEN 'New Customers' THEN 'MEDIUM' ELSE 'HIGH' END AS priority,
      CASE segment WHEN 'Champions' THEN 'VIP Stewardship Program' WHEN 'At Risk' THEN 'Urgent Retention Campaign' ELSE 'New Donor Journey' END AS strategy
      FROM summary WHERE segment IN ('Champions', 'At Risk', 'New Customers')""",
)
def _(crm):
    summary = R.segment_summary(R.rfm_segments(crm.gifts, AS_OF))
    return R.segment_actions(summary.select("segment", "donors", "revenue"))


@query(
    "R12_health_bands",
    KPI
    + """SELECT donor_percentage, opportunity_rate, states, groups, CASE WHEN donor_percentage > 25 THEN 'strong' WHEN donor_percentage > 10 THEN 'moderate' ELSE 'limited' END AS donor_percentage_band,
      CASE WHEN opportunity_rate > 60 THEN 'strong' WHEN opportunity_rate > 30 THEN 'moderate' ELSE 'low' END AS opportunity_rate_band,
      CASE WHEN groups > 5 THEN 'strong' WHEN groups > 2 THEN 'moderate' ELSE 'low' END AS groups_band,
      CASE WHEN states > 5 THEN 'strong' WHEN states > 2 THEN 'moderate' ELSE 'low' END AS states_band FROM kpi""",
)
def _(crm):
    return R.health_bands(_kpi(crm).select("donor_percentage", "opportunity_rate", "states", "groups"))


def _clustered(crm):
    ages = crm.accounts.select(
        "account_id", F.datediff(F.lit("2001-08-02").cast("date"), "created").alias("donor_age_days")
    )
    return K.kmeans_donors(crm.rfm.join(ages, "account_id", "left"))


@query("K1_kmeans_donors")
def _(crm):
    return _clustered(crm).select("account_id", "cluster")


@query("K2_cluster_profile")
def _(crm):
    return K.cluster_profile(materialize(_clustered(crm)))


@query(
    "K1_clusters_hold_together",
    """SELECT count(*) AS donors, 6 AS clusters, true AS cheaper_than_one_cluster, true AS nearest_centre FROM rfm""",
)
def _(crm):
    """Every donor has a cluster, and nearly all are nearest to their own cluster's mean."""
    names = ["recency_days", "frequency", "total_donated", "avg_donation", "tenure_days", "donor_age_days"]
    rows = materialize(_clustered(crm).select("account_id", "cluster", *names))
    facts = rows.agg(*[F.struct(F.avg(c).alias("m"), F.stddev(c).alias("s")).alias(c) for c in names])
    unit = lambda c: F.try_divide(F.col(c) - F.col("__facts")[c]["m"], F.col("__facts")[c]["s"])
    points = attach(rows, facts).select("account_id", "cluster", *[F.coalesce(unit(c), F.lit(0.0)).alias(c) for c in names])
    means = points.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in names])
    # six rows
    centres = means.agg(F.collect_list(F.struct("cluster", *names)).alias("all"))
    away = lambda m: sum((F.col(c) - m[c]) ** 2 for c in names)
    held = attach(points, centres, "__c")
    near = F.array_min(F.transform(F.col("__c")["all"], lambda m: F.struct(away(m).alias("d"), m["cluster"].alias("cluster"))))
    own = F.filter(F.col("__c")["all"], lambda m: m["cluster"] == F.col("cluster"))[0]
    whole = sum(F.col(c) ** 2 for c in names)
    return held.agg(
        F.count("*").alias("donors"),
        F.count_distinct("cluster").cast("int").alias("clusters"),
        (F.sum(away(own)) < F.sum(whole)).alias("cheaper_than_one_cluster"),
        (F.avg((near["cluster"] == F.col("cluster")).cast("double")) > 0.95).alias("nearest_centre"),
    )


@query(
    "K2_profile_adds_up",
    """SELECT CAST(count(*) AS BIGINT) AS donors, round(sum(total_donated), 2) AS revenue, 100.0::DOUBLE AS revenue_share, true AS named FROM rfm""",
)
def _(crm):
    """Cluster sizes, revenues and shares add up to those of all donors."""
    names = ["Major Donors - Active", "Major Donors - Lapsed", "Frequent Givers", "Recent Donors", "Dormant Donors", "Occasional Donors"]
    profile = K.cluster_profile(materialize(_clustered(crm)))
    return profile.agg(
        F.sum("donors").cast("bigint").alias("donors"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.round(F.sum("revenue_share"), 6).alias("revenue_share"),
        F.every(F.col("cluster_name").isin(*names)).alias("named"),
    )
