"""Queries on aggregates and yearly or monthly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import aggregates as A
from almoner.operators import series as W
from almoner.operators.joins import registrations_per_event
from almoner.operators.ranks import exact_quantiles, quintiles, robust_scores
from almoner.plans.registry import query, rounded
from almoner.plans.search_queries import VOLUNTEER_EXPORT
from almoner.plans.standins import AS_OF, DONATION_YEARS
from almoner.session import materialize
from almoner.sources.sinks import volunteer_export

METRICS = """WITH metrics AS (SELECT account_id, frequency AS gift_count, total_donated, avg_donation AS avg_gift, min_donation AS min_gift,
  max_donation AS max_gift, first_gift, last_gift, frequency AS donation_count, tenure_days, recency_days AS days_since_last FROM rfm)
"""


def _metrics(crm):
    return A.donor_metrics(crm.gifts, AS_OF)


@query("A1_clean_gifts", "SELECT donation_id, account_id, CAST(amount AS DOUBLE) AS amount FROM donations WHERE amount > 0 AND source <> '5-LOW'")
def _(crm):
    # gifts of one source are made unusable in the three ways that must drop a row
    low, status = F.col("source") == "5-LOW", F.col("status")
    dirty = crm.donations.withColumns(
        {
            "amount": F.when(low & (status == "F"), -F.col("amount")).otherwise(F.col("amount")),
            "account_id": F.when(low & (status == "O"), F.lit(None)).otherwise(F.col("account_id")),
            "date": F.when(low & (status == "P"), F.lit(None)).otherwise(F.col("date")),
        }
    )
    return A.clean_gifts(dirty).select("donation_id", "account_id", F.col("amount").cast("double").alias("amount"))


@query("A2_donor_metrics", METRICS + "SELECT * FROM metrics")
def _(crm):
    return _metrics(crm)


@query(
    "A3_exec_totals",
    """SELECT CAST(sum(amount) AS DOUBLE) AS total_revenue, count(DISTINCT account_id) AS total_donors, count(*) AS total_gifts,
      CAST(sum(amount) AS DOUBLE) / count(*) AS avg_gift, CAST(sum(amount) AS DOUBLE) / count(DISTINCT account_id) AS revenue_per_donor FROM gifts""",
)
def _(crm):
    return A.exec_totals(crm.gifts)


@query(
    "A4_major_gifts",
    """WITH t AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.9) AS threshold FROM gifts)
    SELECT round(max(threshold), 4) AS threshold, count(*) FILTER (WHERE CAST(amount AS DOUBLE) >= threshold) AS major_gifts,
      CAST(sum(amount) FILTER (WHERE CAST(amount AS DOUBLE) >= threshold) AS DOUBLE) AS major_revenue,
      CAST(sum(amount) FILTER (WHERE CAST(amount AS DOUBLE) >= threshold) AS DOUBLE) / CAST(sum(amount) AS DOUBLE) * 100.0 AS major_share
    FROM gifts, t""",
)
def _(crm):
    return rounded(A.major_gifts(crm.gifts), "threshold", digits=4)


@query(
    "A5_giving_frequency",
    METRICS
    + """SELECT count(*) FILTER (WHERE gift_count = 1) AS single_gift_donors, count(*) FILTER (WHERE gift_count > 1) AS multi_gift_donors,
      CAST(count(*) FILTER (WHERE gift_count > 1) AS DOUBLE) / count(*) * 100.0 AS repeat_rate, CAST(sum(gift_count) AS DOUBLE) / count(*) AS avg_gifts FROM metrics""",
)
def _(crm):
    return A.giving_frequency(_metrics(crm))


@query("A5_gift_count_histogram", METRICS + "SELECT gift_count, count(*) AS donors FROM metrics WHERE gift_count <= 10 GROUP BY gift_count")
def _(crm):
    return A.gift_count_histogram(_metrics(crm))


@query(
    "A6_value_counts",
    """SELECT state, count(*) AS count, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM accounts) * 100.0 AS share FROM accounts
      GROUP BY state ORDER BY count DESC, state LIMIT 5""",
)
def _(crm):
    return A.value_counts(crm.accounts, "state", 5)


@query(
    "A7_monthly_sum",
    "SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS revenue FROM gifts GROUP BY 1",
)
def _(crm):
    return A.monthly_sum(crm.gifts)


@query(
    "A8_gift_buckets",
    """WITH g AS (SELECT CAST(floor(amount / 10) / 100 AS DECIMAL(18,2)) AS x FROM donations),
      r(gift_range, lo, hi) AS (VALUES ('$1-50', 1, 50), ('$51-250', 51, 250), ('$251-1000', 251, 1000), ('$1001-5000', 1001, 5000), ('$5000+', 5000.01, 1e12))
    SELECT gift_range, coalesce(CAST(sum(x) AS DOUBLE), 0.0) AS revenue FROM r LEFT JOIN g ON x BETWEEN lo AND hi GROUP BY gift_range""",
)
def _(crm):
    # thousandths of each amount, so that the small ranges are filled too
    small = (F.floor(F.col("amount") / 10).cast("decimal(18,2)") / 100).cast("decimal(18,2)")
    return A.gift_buckets(crm.donations.withColumn("amount", small))


@query(
    "A9_avg_by_type",
    """SELECT account_type, round(sum(avg_donation) / count(*), 6) AS avg_value FROM rfm JOIN accounts USING (account_id) GROUP BY account_type""",
)
def _(crm):
    joined = _metrics(crm).join(crm.accounts.select("account_id", "account_type"), "account_id")
    return rounded(A.avg_by_type(joined), "avg_value")


@query(
    "A10_recency_buckets",
    METRICS
    + """SELECT CASE WHEN d < 30 THEN '0-30 days' WHEN d < 90 THEN '30-90 days' WHEN d < 180 THEN '90-180 days' WHEN d < 365 THEN '180-365 days'
      WHEN d < 730 THEN '1-2 years' WHEN d < 1095 THEN '2-3 years' ELSE '3+ years' END AS recency, count(*) AS donors
      FROM (SELECT days_since_last AS d FROM metrics) GROUP BY 1""",
)
def _(crm):
    return A.recency_buckets(_metrics(crm))


@query(
    "A11_monthly_acquisition",
    "SELECT CAST(date_trunc('month', first_gift) AS DATE) AS month, count(*) AS new_donors FROM rfm GROUP BY 1",
)
def _(crm):
    return A.monthly_acquisition(crm.gifts)


@query(
    "A12_lapsed_share",
    """SELECT count(*) AS donors, count(*) FILTER (WHERE recency_days > 365) AS lapsed,
      CAST(count(*) FILTER (WHERE recency_days > 365) AS DOUBLE) / count(*) * 100.0 AS lapsed_share FROM rfm""",
)
def _(crm):
    return A.lapsed_share(_metrics(crm))


@query(
    "A12_top_share",
    """SELECT state, count(*) AS count, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM accounts) * 100.0 AS share FROM accounts
      GROUP BY state ORDER BY count DESC, state LIMIT 1""",
)
def _(crm):
    return A.top_share(crm.accounts, "state")


PERFORMANCE = """WITH pairs AS (SELECT c.campaign_id, d.account_id, d.amount FROM campaigns c JOIN donations d
  ON c.campaign_id = d.campaign_id OR c.campaign_name = d.campaign_name),
sums AS (SELECT campaign_id, CAST(sum(amount) AS DOUBLE) AS total_raised, count(DISTINCT account_id) AS donor_count, count(*) AS donation_count FROM pairs GROUP BY campaign_id),
perf AS (SELECT c.campaign_id, c.campaign_name, coalesce(TRY_CAST(c.goal AS DOUBLE), 0.0) AS goal, coalesce(total_raised, 0.0) AS total_raised,
  coalesce(donor_count, 0) AS donor_count, coalesce(donation_count, 0) AS donation_count,
  CASE WHEN donation_count > 0 THEN total_raised / donation_count ELSE 0.0 END AS avg_donation,
  CASE WHEN TRY_CAST(c.goal AS DOUBLE) > 0 THEN coalesce(total_raised, 0.0) / TRY_CAST(c.goal AS DOUBLE) * 100.0 ELSE 0.0 END AS goal_percentage
  FROM campaigns c LEFT JOIN sums s ON s.campaign_id = c.campaign_id)
"""


def _performance(crm):
    return A.campaign_performance(crm.campaigns, crm.donations)


@query("A13_campaign_performance", PERFORMANCE + "SELECT * FROM perf")
def _(crm):
    return _performance(crm)


@query(
    "A14_campaign_insights",
    PERFORMANCE
    + """, e AS (SELECT *, CASE WHEN donor_count > 0 THEN total_raised / donor_count ELSE 0.0 END AS efficiency FROM perf)
    SELECT count(*) AS campaigns, round(sum(total_raised), 2) AS total_revenue, sum(goal) AS total_goals, round(avg(goal_percentage), 6) AS avg_goal_percentage,
      CAST(sum(donor_count) AS BIGINT) AS total_donors, arg_max(campaign_name, total_raised) AS top_campaign, arg_max(campaign_name, efficiency) AS most_efficient,
      count(*) FILTER (WHERE goal_percentage > 110) AS over_110, count(*) FILTER (WHERE goal_percentage < 80) AS under_80,
      count(*) FILTER (WHERE efficiency > (SELECT avg(efficiency) FROM e)) AS above_mean_efficiency FROM e""",
)
def _(crm):
    return rounded(rounded(A.campaign_insights(_performance(crm)), "avg_goal_percentage"), "total_revenue", digits=2)


@query(
    "A15_goal_band",
    PERFORMANCE + "SELECT campaign_id, CASE WHEN goal_percentage >= 100 THEN 'green' WHEN goal_percentage >= 80 THEN 'orange' ELSE 'red' END AS goal_band FROM perf",
)
def _(crm):
    return A.goal_band(_performance(crm)).select("campaign_id", "goal_band")


@query(
    "A16_donation_summary",
    """SELECT count(*) AS donations, CAST(sum(amount) AS DOUBLE) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS average,
      CAST(max(amount) AS DOUBLE) AS largest, CAST(min(amount) AS DOUBLE) AS smallest FROM donations WHERE date >= TIMESTAMP '2000-08-02'""",
)
def _(crm):
    from almoner.operators.search import since

    return A.donation_summary(since(crm.donations, "date", AS_OF, years=1))


@query(
    "A17_size_buckets",
    """WITH b AS (SELECT CASE WHEN value <= 25 THEN '<=25' WHEN value <= 100 THEN '<=100' WHEN value <= 500 THEN '<=500' WHEN value <= 1000 THEN '<=1000' ELSE '>1000' END AS size_bucket FROM events)
    SELECT size_bucket, count(*) AS donations, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM b) * 100.0 AS share FROM b GROUP BY 1""",
)
def _(crm):
    return A.size_buckets(crm.table("events").select(F.col("value").alias("amount")))


@query(
    "A18_source_counts",
    """SELECT source, count(*) AS count, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM donations) * 100.0 AS share FROM donations
      GROUP BY source ORDER BY count DESC, source LIMIT 5""",
)
def _(crm):
    return A.source_counts(crm.donations)


@query("A18_pledge_totals", "SELECT count(*) AS pledges, CAST(sum(amount) AS DOUBLE) AS pledged FROM donations WHERE status = 'P'")
def _(crm):
    return A.pledge_totals(crm.donations.where(F.col("status") == "P"))


@query(
    "A19_campaign_totals",
    "SELECT campaign_name, count(*) AS gifts, CAST(sum(amount) AS DOUBLE) AS total FROM donations WHERE amount >= 300000 GROUP BY campaign_name",
)
def _(crm):
    return A.campaign_totals(crm.donations, 300000)


@query(
    "A20_recurring_summary",
    """WITH x AS (SELECT status, frequency, CASE WHEN lower(status) = 'active' THEN amount END AS a FROM recurring)
    SELECT 'status' AS dimension, status AS value, count(*) AS recurring, coalesce(CAST(sum(a) AS DOUBLE), 0.0) AS active_amount FROM x GROUP BY status
    UNION ALL SELECT 'frequency', frequency, count(*), coalesce(CAST(sum(a) AS DOUBLE), 0.0) FROM x GROUP BY frequency
    UNION ALL SELECT 'total', 'all', count(*), CAST(sum(a) AS DOUBLE) FROM x""",
)
def _(crm):
    return A.recurring_summary(crm.recurring)


@query(
    "A21_registration_status",
    """SELECT status, count(*) AS count, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM registrations) * 100.0 AS share FROM registrations GROUP BY status""",
)
def _(crm):
    return A.registration_status(crm.registrations)


@query(
    "A21_event_summary",
    """WITH e AS (SELECT e.event_id, count(r.registration_id) AS n FROM crm_events e LEFT JOIN registrations r ON r.event_id = e.event_id GROUP BY 1)
    SELECT count(*) AS events, CAST(sum(n) AS BIGINT) AS total_registrations, CAST(sum(n) AS DOUBLE) / count(*) AS avg_registrations,
      (SELECT event_id FROM e ORDER BY n DESC, event_id DESC LIMIT 1) AS most_popular FROM e""",
)
def _(crm):
    return A.event_summary(registrations_per_event(crm.crm_events, crm.registrations))


ACTIVE = """WITH act AS (SELECT *, coalesce(term_end >= TIMESTAMP '2001-08-02', false) AS is_active FROM memberships)
"""


@query(
    "A22_membership_summary",
    ACTIVE
    + "SELECT count(*) AS memberships, count(*) FILTER (WHERE is_active) AS active_memberships, count(DISTINCT account_id) AS members, CAST(sum(fee) AS DOUBLE) AS fee_total FROM act",
)
def _(crm):
    return A.membership_summary(crm.memberships, AS_OF)


@query(
    "A23_membership_retention",
    ACTIVE
    + """, l AS (SELECT level, count(*) AS total, count(*) FILTER (WHERE is_active) AS active FROM act WHERE level IS NOT NULL GROUP BY level
      UNION ALL SELECT '(all)', count(*), count(*) FILTER (WHERE is_active) FROM act)
    SELECT level, total, active, CAST(active AS DOUBLE) / total * 100.0 AS retention_rate FROM l""",
)
def _(crm):
    return A.membership_retention(crm.memberships, AS_OF)


@query(
    "A24_level_revenue",
    """WITH l AS (SELECT level, CAST(sum(fee) AS DOUBLE) AS revenue, CAST(sum(fee) AS DOUBLE) / count(fee) AS avg_fee, count(fee) AS memberships FROM memberships WHERE level IS NOT NULL GROUP BY level)
    SELECT *, round(revenue / (SELECT sum(revenue) FROM l) * 100.0, 6) AS revenue_share FROM l""",
)
def _(crm):
    return rounded(A.level_revenue(crm.memberships), "revenue_share")


@query(
    "A25_expiry_distribution",
    """WITH d AS (SELECT date_diff('day', TIMESTAMP '2001-08-02', term_end) AS d FROM memberships WHERE term_end IS NOT NULL)
    SELECT CASE WHEN d <= 0 THEN 'Expired' WHEN d <= 30 THEN '0-30 days' WHEN d <= 90 THEN '31-90 days' WHEN d <= 180 THEN '91-180 days'
      WHEN d <= 365 THEN '181-365 days' ELSE '365+ days' END AS expiry, count(*) AS memberships, count(*) FILTER (WHERE d > 0 AND d <= 30) AS at_risk FROM d GROUP BY 1""",
)
def _(crm):
    return A.expiry_distribution(crm.memberships, AS_OF)


@query(
    "A26_enrolment_series",
    """SELECT 'month' AS grain, CAST(date_trunc('month', transaction_date) AS DATE) AS period, count(*) AS enrolments, CAST(sum(fee) AS DOUBLE) AS revenue FROM memberships GROUP BY 2
      UNION ALL SELECT 'year', CAST(date_trunc('year', transaction_date) AS DATE), count(*), CAST(sum(fee) AS DOUBLE) FROM memberships GROUP BY 2""",
)
def _(crm):
    monthly = A.enrolment_series(crm.memberships).withColumn("grain", F.lit("month"))
    return monthly.unionByName(A.enrolment_series(crm.memberships, "year").withColumn("grain", F.lit("year")))


@query(
    "A27_enrolment_trend",
    """WITH m AS (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS period, count(*) AS n FROM memberships GROUP BY 1),
      x AS (SELECT *, row_number() OVER (ORDER BY period) - 1 AS x FROM m)
    SELECT round(regr_slope(n, x), 6) AS slope, round(regr_intercept(n, x), 6) AS intercept, round(regr_r2(n, x), 6) AS r2, count(*) AS months,
      CAST(sum(n) AS DOUBLE) / count(*) AS avg_per_month, (SELECT period FROM m ORDER BY n DESC, period LIMIT 1) AS peak_month,
      max(n) AS peak_enrolments, CAST(sum(n) AS BIGINT) AS total_enrolments FROM x""",
)
def _(crm):
    return rounded(A.enrolment_trend(A.enrolment_series(crm.memberships)), "slope", "intercept", "r2")


KPIS = VOLUNTEER_EXPORT + """, kpi AS (SELECT count(*) AS total_volunteers, count(*) FILTER (WHERE has_opportunities = 1) AS with_opportunities,
  count(*) FILTER (WHERE has_group = 1) AS with_groups, CAST(count(*) FILTER (WHERE has_opportunities = 1) AS DOUBLE) / count(*) * 100.0 AS opportunity_rate,
  CAST(count(*) FILTER (WHERE has_group = 1) AS DOUBLE) / count(*) * 100.0 AS group_rate,
  count(*) FILTER (WHERE kind = 'INDIVIDUAL') AS individuals, count(*) FILTER (WHERE kind = 'Organization') AS organisations,
  CAST(sum(opportunity_count) AS BIGINT) AS total_opportunities, CAST(sum(opportunity_count) AS DOUBLE) / count(*) FILTER (WHERE has_opportunities = 1) AS avg_opportunities,
  CAST(max(opportunity_count) AS INTEGER) AS max_opportunities FROM exported)
"""


@query("A28_volunteer_kpis", KPIS + "SELECT * FROM kpi")
def _(crm):
    return A.volunteer_kpis(crm.volunteers.withColumnRenamed("kind", "account_type"))


@query("A29_opportunity_stats", KPIS + "SELECT total_opportunities, avg_opportunities, max_opportunities FROM kpi")
def _(crm):
    return A.opportunity_stats(crm.volunteers.withColumnRenamed("kind", "account_type"))


@query(
    "A30_dimension_counts",
    """WITH long AS (SELECT 'volunteer_group' AS dimension, volunteer_group AS value FROM volunteer_rows UNION ALL SELECT 'volunteer_role', volunteer_role FROM volunteer_rows
      UNION ALL SELECT 'state', state FROM volunteer_rows UNION ALL SELECT 'city', city FROM volunteer_rows),
    c AS (SELECT dimension, value, count(*) AS count FROM long WHERE value IS NOT NULL AND trim(value) <> '' GROUP BY ALL)
    SELECT dimension, value, count, CAST(row_number() OVER (PARTITION BY dimension ORDER BY count DESC, value) AS INTEGER) AS rank FROM c QUALIFY rank <= 10""",
)
def _(crm):
    return A.dimension_counts(crm.volunteer_rows, ["volunteer_group", "volunteer_role", "state", "city"], 10)


@query(
    "A31_group_summary",
    VOLUNTEER_EXPORT
    + """SELECT volunteer_group, count(account_id) AS total_volunteers, CAST(sum(opportunity_count) AS BIGINT) AS total_opportunities,
      CAST(sum(is_active_participant) AS BIGINT) AS active_participants, CAST(sum(participation_score) AS DOUBLE) / count(*) AS avg_participation_score
      FROM exported WHERE volunteer_group IS NOT NULL GROUP BY volunteer_group""",
)
def _(crm):
    return A.group_summary(volunteer_export(crm.volunteers))


@query(
    "A32_participation_distribution",
    VOLUNTEER_EXPORT
    + """SELECT participation_score, count(*) AS volunteers, CASE participation_score WHEN 0 THEN 'No Participation' WHEN 1 THEN 'Low Participation'
      WHEN 2 THEN 'Moderate Participation' ELSE 'High Participation' END AS label FROM exported GROUP BY participation_score""",
)
def _(crm):
    return A.participation_distribution(volunteer_export(crm.volunteers))


@query(
    "A32_opportunity_distribution",
    VOLUNTEER_EXPORT + "SELECT opportunity_count, count(*) AS volunteers FROM exported WHERE opportunity_count > 0 GROUP BY 1",
)
def _(crm):
    return A.opportunity_distribution(volunteer_export(crm.volunteers))


@query(
    "A33_program_status",
    """WITH p AS (SELECT 'memberships' AS program, count(*) AS count FROM memberships UNION ALL SELECT 'volunteers', count(*) FROM volunteers
      UNION ALL SELECT 'donations', count(*) FROM donations UNION ALL SELECT 'recurring', count(*) FROM recurring WHERE status = 'None' UNION ALL SELECT 'accounts', count(*) FROM accounts)
    SELECT program, count, count > 0 AS active, (SELECT CAST(count(*) FILTER (WHERE count > 0) AS DOUBLE) / count(*) * 100.0 FROM p) AS utilisation FROM p""",
)
def _(crm):
    return A.program_status(_programs(crm))


def _programs(crm):
    return {
        "memberships": crm.memberships,
        "volunteers": crm.volunteers,
        "donations": crm.donations,
        "recurring": crm.recurring.where(F.col("status") == "None"),
        "accounts": crm.accounts,
    }


@query(
    "A34_program_distributions",
    """SELECT 'level' AS dimension, coalesce(level, 'Unknown') AS value, count(*) AS count FROM memberships GROUP BY 2
      UNION ALL SELECT 'volunteer_group', coalesce(volunteer_group, 'Unknown'), count(*) FROM volunteers GROUP BY 2
      UNION ALL SELECT 'volunteer_role', coalesce(volunteer_role, 'Unknown'), count(*) FROM volunteers GROUP BY 2
      UNION ALL SELECT 'account_type', coalesce(account_type, 'Unknown'), count(*) FROM accounts GROUP BY 2
      UNION ALL SELECT 'city', coalesce(city, 'Unknown'), count(*) FROM accounts GROUP BY 2""",
)
def _(crm):
    parts = [
        A.program_distributions(crm.memberships, ["level"]),
        A.program_distributions(crm.volunteers, ["volunteer_group", "volunteer_role"]),
        A.program_distributions(crm.accounts, ["account_type", "city"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "A35_donation_program",
    """WITH d AS (SELECT coalesce(campaign_name, 'Unknown') AS campaign, coalesce(fund, 'General Fund') AS fund, strftime(date, '%Y-%m') AS month, amount FROM donations),
      l AS (SELECT 'campaign' AS dimension, campaign AS value, amount FROM d UNION ALL SELECT 'fund', fund, amount FROM d UNION ALL SELECT 'month', month, amount FROM d UNION ALL SELECT 'total', 'all', amount FROM d)
    SELECT dimension, value, count(*) AS donations, CAST(sum(amount) AS DOUBLE) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS average FROM l GROUP BY ALL""",
)
def _(crm):
    return A.donation_program(crm.donations)


@query(
    "A36_donor_percentage",
    """WITH f AS (SELECT account_id IN (SELECT account_id FROM donations WHERE date >= TIMESTAMP '2001-01-01') AS d FROM accounts)
    SELECT count(*) AS accounts, count(*) FILTER (WHERE d) AS donors, CAST(count(*) FILTER (WHERE d) AS DOUBLE) / count(*) * 100.0 AS donor_percentage FROM f""",
)
def _(crm):
    recent = crm.donations.where(F.col("date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return A.donor_percentage(crm.accounts, recent)


@query(
    "A37_geographic_reach",
    """SELECT 'accounts' AS program, count(DISTINCT state) AS states FROM accounts UNION ALL SELECT 'volunteers', count(DISTINCT state) FROM volunteer_rows""",
)
def _(crm):
    return A.geographic_reach({"accounts": crm.accounts, "volunteers": crm.volunteer_rows})


@query(
    "A38_donor_contrast",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(coalesce(avg({m}) FILTER (WHERE is_donor = 1), 0.0), 6) AS donors,
        round(coalesce(avg({m}) FILTER (WHERE is_donor = 0), 0.0), 6) AS others,
        round(coalesce(avg({m}) FILTER (WHERE is_donor = 1), 0.0) - coalesce(avg({m}) FILTER (WHERE is_donor = 0), 0.0), 6) AS difference FROM features"""
        for m in ("attends_events", "has_active_membership", "is_volunteer", "account_age_years", "has_recent_activity")
    ),
)
def _(crm):
    return rounded(A.donor_contrast(crm.features), "donors", "others", "difference")


@query(
    "A39_type_analysis",
    """SELECT account_type, count(*) AS accounts, CAST(sum(is_donor) AS BIGINT) AS donors, CAST(sum(is_donor) AS DOUBLE) / count(*) AS donor_rate,
      CAST(sum(is_major_donor) AS BIGINT) AS major_donors, round(sum(lifetime_donation_amount) / count(*), 4) AS avg_lifetime FROM features GROUP BY account_type""",
)
def _(crm):
    return rounded(A.type_analysis(crm.features), "avg_lifetime", digits=4)


@query(
    "A40_prime_prospects",
    """SELECT count(*) FILTER (WHERE is_donor = 0 AND has_recent_activity = 1) AS high_engagement, count(*) FILTER (WHERE is_donor = 0 AND has_active_membership = 1) AS members,
      count(*) FILTER (WHERE is_donor = 0 AND is_volunteer = 1) AS volunteers, count(*) FILTER (WHERE is_donor = 0 AND attends_events = 1) AS attendees FROM features""",
)
def _(crm):
    return A.prime_prospects(crm.features.withColumn("high_engagement", F.col("has_recent_activity")))


@query(
    "A42_rate_by_factor",
    " UNION ALL ".join(
        f"SELECT '{f}' AS factor, round(avg(is_donor) FILTER (WHERE {f} = 1), 6) AS rate_with, round(avg(is_donor) FILTER (WHERE {f} = 0), 6) AS rate_without FROM features"
        for f in ("attends_events", "is_company", "has_phone")
    ),
)
def _(crm):
    return rounded(A.rate_by_factor(crm.features, ["attends_events", "is_company", "has_phone"]), "rate_with", "rate_without")


@query(
    "A44_field_type_inventory",
    """WITH f AS (SELECT coalesce(data_type, 'Unknown') AS data_type, name FROM custom_fields),
      n AS (SELECT data_type, string_agg(name, ', ' ORDER BY name) AS examples FROM (SELECT DISTINCT data_type, name FROM f QUALIFY dense_rank() OVER (PARTITION BY data_type ORDER BY name) <= 3) GROUP BY 1)
    SELECT f.data_type, count(*) AS fields, any_value(examples) AS examples FROM f JOIN n ON n.data_type = f.data_type GROUP BY f.data_type""",
)
def _(crm):
    return A.field_type_inventory(crm.custom_fields)


@query(
    "A45_name_length_stats",
    """SELECT CAST(sum(length(name)) AS DOUBLE) / count(*) AS avg_length, CAST(median(length(name)) AS DOUBLE) AS median_length, CAST(min(length(name)) AS INTEGER) AS min_length,
      CAST(max(length(name)) AS INTEGER) AS max_length, (SELECT name FROM custom_fields ORDER BY length(name) DESC, name LIMIT 1) AS longest,
      (SELECT name FROM custom_fields ORDER BY length(name), name LIMIT 1) AS shortest FROM custom_fields""",
)
def _(crm):
    return A.name_length_stats(crm.custom_fields)


@query(
    "W1_pareto",
    """WITH t AS (SELECT account_id, sum(amount) AS total FROM gifts GROUP BY account_id),
      c AS (SELECT account_id, total, sum(total) OVER (ORDER BY total DESC, account_id) AS running FROM t)
    SELECT account_id, CAST(total AS DOUBLE) AS total_donated, CAST(running AS DOUBLE) AS cumulative,
      CAST(running AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM t) * 100.0 AS cumulative_share FROM c""",
)
def _(crm):
    return W.pareto(_metrics(crm))


@query(
    "W2_annual_retention",
    """WITH y AS (SELECT DISTINCT account_id, CAST(year(date) AS INTEGER) AS year FROM donations),
      n AS (SELECT year, lead(year) OVER (ORDER BY year) AS next_year FROM (SELECT DISTINCT year FROM y)),
      r AS (SELECT a.year, count(*) AS donors, count(b.account_id) AS retained FROM y a JOIN n ON n.year = a.year AND n.next_year IS NOT NULL
        LEFT JOIN y b ON b.account_id = a.account_id AND b.year = n.next_year GROUP BY a.year)
    SELECT r.year, n.next_year, donors, retained, CAST(retained AS DOUBLE) / donors * 100.0 AS retention_rate FROM r JOIN n ON n.year = r.year""",
)
def _(crm):
    return W.annual_retention(crm.donations)


@query(
    "W2_year_pair",
    """WITH a AS (SELECT DISTINCT account_id FROM donations WHERE year(date) = 2000), b AS (SELECT DISTINCT account_id FROM donations WHERE year(date) = 2001),
      k AS (SELECT (SELECT count(*) FROM a) AS donors_last_year, (SELECT count(*) FROM b) AS donors_this_year,
        (SELECT count(*) FROM a JOIN b USING (account_id)) AS retained, (SELECT count(*) FROM b WHERE account_id NOT IN (FROM a)) AS new_donors)
    SELECT *, CAST(retained AS DOUBLE) / donors_last_year * 100.0 AS retention_rate, CAST(new_donors AS DOUBLE) / donors_this_year * 100.0 AS acquisition_rate FROM k""",
)
def _(crm):
    return W.year_pair(crm.donations, AS_OF)


@query(
    "W3_pct_change",
    """WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS revenue FROM gifts GROUP BY 1)
    SELECT month, revenue, (revenue - lag(revenue) OVER (ORDER BY month)) / lag(revenue) OVER (ORDER BY month) * 100.0 AS pct_change FROM m""",
)
def _(crm):
    return W.pct_change(A.monthly_sum(crm.gifts), "revenue", "month")


@query(
    "W4_cumulative",
    """WITH m AS (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS period, count(*) AS enrolments FROM memberships GROUP BY 1)
    SELECT period, enrolments, CAST(sum(enrolments) OVER (ORDER BY period) AS BIGINT) AS cumulative FROM m""",
)
def _(crm):
    return W.cumulative(A.enrolment_series(crm.memberships), "enrolments", "period").drop("revenue")


@query(
    "W5_quintile",
    """WITH r AS (SELECT account_id, row_number() OVER (ORDER BY recency_days, account_id) - 1 AS a,
      row_number() OVER (ORDER BY total_donated, account_id) - 1 AS b, count(*) OVER () - 1 AS n FROM rfm)
    SELECT account_id, CAST(6 - greatest(1, (5 * a + n - 1) // n) AS INTEGER) AS recency_score, CAST(greatest(1, (5 * b + n - 1) // n) AS INTEGER) AS money_score FROM r""",
)
def _(crm):
    scored = quintiles(
        materialize(crm.rfm),
        "account_id",
        {"recency_score": F.col("recency_days"), "money_score": F.col("total_donated")},
        reverse=["recency_score"],
    )
    return scored.select("account_id", "recency_score", "money_score")


@query(
    "W6_robust_score",
    """WITH s AS (SELECT account_id, frequency, total_donated, count(*) OVER () AS n, rank() OVER (ORDER BY frequency) + (count(*) OVER (PARTITION BY frequency) - 1) / 2.0 AS avg_rank FROM rfm),
      e AS (SELECT quantile_cont(total_donated, 0.2) AS e1, quantile_cont(total_donated, 0.4) AS e2, quantile_cont(total_donated, 0.6) AS e3, quantile_cont(total_donated, 0.8) AS e4 FROM rfm)
    SELECT account_id, CAST(ceil(5 * avg_rank / n) AS DOUBLE) AS frequency_score,
      CASE WHEN total_donated <= e1 THEN 5.0::DOUBLE WHEN total_donated <= e2 THEN 4.0 WHEN total_donated <= e3 THEN 3.0 WHEN total_donated <= e4 THEN 2.0 ELSE 1.0 END AS total_score FROM s, e""",
)
def _(crm):
    scored = robust_scores(
        materialize(crm.rfm),
        {"frequency_score": (F.col("frequency"), True), "total_score": (F.col("total_donated"), False)},
    )
    return scored.select("account_id", "frequency_score", "total_score")


@query(
    "W7_yearly_giving",
    "SELECT account_id, "
    + ", ".join(f"coalesce(CAST(sum(amount) FILTER (WHERE year(date) = {y}) AS DOUBLE), 0.0) AS y{y}" for y in DONATION_YEARS)
    + " FROM donations GROUP BY account_id",
)
def _(crm):
    return W.yearly_giving(crm.donations, DONATION_YEARS)


YOY = """WITH w AS (SELECT account_id, coalesce(CAST(sum(amount) FILTER (WHERE year(date) = 2000) AS DOUBLE), 0.0) AS a, coalesce(CAST(sum(amount) FILTER (WHERE year(date) = 2001) AS DOUBLE), 0.0) AS b FROM donations GROUP BY 1),
yoy AS (SELECT account_id, a > 0 AS gave_last_year, b > 0 AS gave_this_year, a AS last_year_amount, b AS this_year_amount, CASE WHEN a = 0 THEN 0.0 ELSE (b - a) / a END AS yoy_growth FROM w)
"""


@query("W8_yoy", YOY + "SELECT * FROM yoy")
def _(crm):
    return W.yoy(crm.donations, AS_OF)


@query(
    "W9_rm_matrix",
    """WITH e AS (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(total_donated, [0.2, 0.4, 0.6, 0.8]) AS m FROM rfm),
      b AS (SELECT CASE WHEN recency_days <= r[1] THEN 'Very Recent' WHEN recency_days <= r[2] THEN 'Recent' WHEN recency_days <= r[3] THEN 'Moderate' WHEN recency_days <= r[4] THEN 'Old' ELSE 'Very Old' END AS recency_bin,
        CASE WHEN total_donated <= m[1] THEN 1 WHEN total_donated <= m[2] THEN 2 WHEN total_donated <= m[3] THEN 3 WHEN total_donated <= m[4] THEN 4 ELSE 5 END AS k FROM rfm, e)
    SELECT recency_bin, count(*) FILTER (WHERE k = 1) AS low, count(*) FILTER (WHERE k = 2) AS low_med, count(*) FILTER (WHERE k = 3) AS medium,
      count(*) FILTER (WHERE k = 4) AS med_high, count(*) FILTER (WHERE k = 5) AS high FROM b GROUP BY 1""",
)
def _(crm):
    return W.rm_matrix(materialize(crm.rfm))


@query(
    "W10_scalar_quantiles",
    """SELECT round(quantile_cont(total_donated, 0.5), 4) AS median_total, round(quantile_cont(total_donated, 0.8), 4) AS p80_total,
      quantile_cont(CAST(frequency AS DOUBLE), 0.7) AS p70_frequency FROM rfm""",
)
def _(crm):
    wanted = {
        "median_total": (F.col("total_donated"), 0.5),
        "p80_total": (F.col("total_donated"), 0.8),
        "p70_frequency": (F.col("frequency"), 0.7),
    }
    return rounded(exact_quantiles(crm.rfm, wanted), "median_total", "p80_total", digits=4)
