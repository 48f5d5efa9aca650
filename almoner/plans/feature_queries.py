"""Queries on account features, propensity models and prospects."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import aggregates as A
from almoner.operators import features as E
from almoner.plans.registry import query, rounded
from almoner.plans.standins import AS_OF

RAW = """WITH raw AS (SELECT f.account_id, CASE WHEN f.donation_count = 0 THEN 'none' ELSE CAST(f.donation_count * 700 AS VARCHAR) END AS total_giving, f.donation_count,
  a.email AS email_1, a.phone AS phone_1, a.city, a.created, a.modified, CAST(f.events_attended AS VARCHAR) AS event_registrations, f.membership_count AS memberships_held,
  CASE WHEN f.is_volunteer = 1 THEN 5 ELSE 0 END AS volunteer_hours, f.is_company, f.total_membership_fees FROM features f JOIN accounts a USING (account_id))
"""


def _raw(crm):
    profile = crm.accounts.select("account_id", "email", "phone", "city", "created", "modified")
    n = F.col("donation_count")
    return crm.features.join(profile, "account_id").select(
        "account_id",
        F.when(n == 0, "none").otherwise((n * 700).cast("string")).alias("total_giving"),
        n,
        F.col("email").alias("email_1"),
        F.col("phone").alias("phone_1"),
        "city",
        "created",
        "modified",
        F.col("events_attended").cast("string").alias("event_registrations"),
        F.col("membership_count").alias("memberships_held"),
        F.when(F.col("is_volunteer") == 1, 5).otherwise(0).alias("volunteer_hours"),
        "is_company",
        "total_membership_fees",
    )


def _built(crm):
    raw = _raw(crm)
    cols = E.discover_columns(["total_giving", "donation_count", "email_1", "phone_1", "city", "created", "modified", "event_registrations", "memberships_held", "volunteer_hours"])
    out = E.contact_features(E.targets(raw, cols), cols)
    return E.engagement_flags(E.age_features(out, cols, AS_OF), cols)


BUILT = RAW + """, built AS (SELECT account_id, CASE WHEN donation_count > 0 THEN donation_count * 700.0::DOUBLE ELSE 0.0 END AS lifetime_donation_amount, CAST(donation_count AS DOUBLE) AS donation_count,
  CASE WHEN donation_count > 0 THEN 1 ELSE 0 END AS is_donor, CASE WHEN donation_count * 700 >= 1000 THEN 1 ELSE 0 END AS is_major_donor,
  CASE WHEN email_1 IS NULL THEN 0 ELSE 1 END AS has_email, CASE WHEN phone_1 IS NULL THEN 0 ELSE 1 END AS has_phone, CASE WHEN city IS NULL THEN 0 ELSE 1 END AS has_address,
  date_diff('day', created, TIMESTAMP '2001-08-02') AS account_age_days, date_diff('day', modified, TIMESTAMP '2001-08-02') AS days_since_last_activity,
  CASE WHEN date_diff('day', modified, TIMESTAMP '2001-08-02') <= 180 THEN 1 ELSE 0 END AS has_recent_activity,
  CASE WHEN CAST(event_registrations AS BIGINT) > 0 THEN 1 ELSE 0 END AS event_engagement, CASE WHEN memberships_held > 0 THEN 1 ELSE 0 END AS membership_engagement,
  CASE WHEN volunteer_hours > 0 THEN 1 ELSE 0 END AS activity_engagement, is_company, total_membership_fees, memberships_held, volunteer_hours FROM raw),
parts AS (SELECT *, CAST(has_email + has_phone + has_address AS DOUBLE) / 3 AS contact_completeness FROM built),
varied AS (SELECT * FROM parts, (SELECT CAST(max(contact_completeness) > min(contact_completeness) AS INTEGER) AS v1, CAST(max(has_recent_activity) > min(has_recent_activity) AS INTEGER) AS v2,
  CAST(max(event_engagement) > min(event_engagement) AS INTEGER) AS v3, CAST(max(membership_engagement) > min(membership_engagement) AS INTEGER) AS v4, CAST(max(activity_engagement) > min(activity_engagement) AS INTEGER) AS v5 FROM parts)),
engaged AS (SELECT *, round((contact_completeness * v1 + has_recent_activity * v2 + event_engagement * v3 + membership_engagement * v4 + activity_engagement * v5) / (v1 + v2 + v3 + v4 + v5), 9) AS engagement_score FROM varied)
"""


DISCOVERED = (
    ("donation_amount", "total_giving"), ("donation_count", "donation_count"), ("phone", "phone_1"), ("address", "city"),
    ("email", "email_1"), ("date", "created"), ("date", "modified"), ("event", "event_registrations"),
    ("membership", "memberships_held"), ("membership", "total_membership_fees"), ("activity", "volunteer_hours"),
)


@query(
    "E1_discover_columns",
    RAW + " UNION ALL ".join(f"SELECT '{kind}' AS kind, '{name}' AS \"column\", count({name}) AS filled FROM raw" for kind, name in DISCOVERED),
)
def _(crm):
    return E.discovered_fill(_raw(crm))


@query("E2_targets", BUILT + "SELECT account_id, lifetime_donation_amount, donation_count, is_donor, is_major_donor FROM built")
def _(crm):
    return _built(crm).select("account_id", "lifetime_donation_amount", "donation_count", "is_donor", "is_major_donor")


@query("E3_contact_features", BUILT + "SELECT account_id, has_email, has_phone, has_address, round(contact_completeness, 9) AS contact_completeness FROM parts")
def _(crm):
    out = _built(crm).select("account_id", "has_email", "has_phone", "has_address", "contact_completeness")
    return rounded(out, "contact_completeness", digits=9)


@query(
    "E4_age_features",
    BUILT + "SELECT account_id, account_age_days, round(account_age_days / 365.25::DOUBLE, 9) AS account_age_years, days_since_last_activity, has_recent_activity FROM built",
)
def _(crm):
    out = _built(crm).select("account_id", "account_age_days", "account_age_years", "days_since_last_activity", "has_recent_activity")
    return rounded(out, "account_age_years", digits=9)


@query("E5_engagement_flags", BUILT + "SELECT account_id, event_engagement, membership_engagement, activity_engagement FROM built")
def _(crm):
    return _built(crm).select("account_id", "event_engagement", "membership_engagement", "activity_engagement")


@query("E6_engagement_score", BUILT + "SELECT account_id, engagement_score, CASE WHEN engagement_score >= 0.6 THEN 1 ELSE 0 END AS high_engagement FROM engaged")
def _(crm):
    out = E.engagement_score(_built(crm)).select("account_id", "engagement_score", "high_engagement")
    return rounded(out, "engagement_score", digits=9)


@query("E7_capacity_flag", BUILT + "SELECT account_id, CASE WHEN is_company = 1 OR total_membership_fees > 500 THEN 1 ELSE 0 END AS potential_high_capacity FROM built")
def _(crm):
    return E.capacity_flag(_built(crm)).select("account_id", "potential_high_capacity")


@query(
    "E8_has_flags",
    RAW + "SELECT account_id, CASE WHEN donation_count > 0 THEN 1 ELSE 0 END AS has_donation_count, CASE WHEN memberships_held > 0 THEN 1 ELSE 0 END AS has_memberships_held, CASE WHEN volunteer_hours > 0 THEN 1 ELSE 0 END AS has_volunteer_hours FROM raw",
)
def _(crm):
    flagged = E.has_flags(_raw(crm).select("account_id", "donation_count", "memberships_held", "volunteer_hours"))
    return flagged.drop("donation_count", "memberships_held", "volunteer_hours")


MODEL_FEATURES = (
    "is_company",
    "has_email",
    "has_phone",
    "has_address",
    "account_age_years",
    "has_recent_activity",
    "events_attended",
    "attends_events",
    "has_active_membership",
    "total_membership_fees",
    "membership_count",
    "is_volunteer",
)


@query("E9_fit_propensity")
def _(crm):
    result = E.fit_propensity(crm.features, MODEL_FEATURES)
    rows = [(name, float(auc), name == result.best) for name, auc in result.aucs.items()]
    return crm.spark.createDataFrame(rows, "model string, auc double, best boolean")


@query("E10_score_all")
def _(crm):
    return E.score_all(E.fit_propensity(crm.features, MODEL_FEATURES))


def _planted(crm):
    """Accounts whose label follows from two features, so that models have something to find."""
    gives = (F.col("has_phone") == 1) & ((F.col("is_company") == 1) | (F.col("events_attended") > 6))
    return crm.features.withColumn("is_donor", gives.cast("int"))


PLANTED = "planted AS (SELECT *, CASE WHEN has_phone = 1 AND (is_company = 1 OR events_attended > 6) THEN 1 ELSE 0 END AS gives FROM features)"


@query(
    "E9_test_share",
    "WITH " + PLANTED + " SELECT gives AS is_donor, count(*) AS accounts, CAST(round(count(*) * 0.3) AS BIGINT) AS test_rows FROM planted GROUP BY gives",
)
def _(crm):
    split = E.stratified_split(_planted(crm).select("account_id", "is_donor"), "account_id", "is_donor")
    return split.groupBy("is_donor").agg(F.count("*").alias("accounts"), F.count_if("is_test").alias("test_rows"))


@query(
    "E9_planted_signal",
    "SELECT model, true AS better_than_chance FROM (VALUES ('random_forest'), ('gradient_boosting'), ('logistic_regression')) AS m(model)",
)
def _(crm):
    result = E.fit_propensity(_planted(crm), MODEL_FEATURES, trees=20, rounds=5)
    rows = [(name, bool(auc > 0.6)) for name, auc in result.aucs.items()]
    return crm.spark.createDataFrame(rows, "model string, better_than_chance boolean")


@query(
    "E10_bands_follow_scores",
    "WITH " + PLANTED + """ SELECT count(*) AS accounts, count(*) AS in_range, count(*) AS consistent, true AS donors_score_higher FROM planted""",
)
def _(crm):
    planted = _planted(crm)
    scored = E.score_all(E.fit_propensity(planted, MODEL_FEATURES, trees=20, rounds=5))
    s = F.col("score")
    band = F.when(s > 0.7, "High").when(s > 0.5, "Medium").otherwise("Low")
    agrees = (F.col("score_band") == band) & (F.col("high_propensity") == (s > 0.7).cast("int"))
    means = [F.avg(F.when(F.col("is_donor") == k, s)) for k in (0, 1)]
    return scored.join(planted.select("account_id", "is_donor"), "account_id").agg(
        F.count("*").alias("accounts"),
        F.count_if(s.between(0, 1)).alias("in_range"),
        F.count_if(agrees).alias("consistent"),
        (means[1] > means[0]).alias("donors_score_higher"),
    )


@query(
    "E10_score_bands",
    """WITH s AS (SELECT account_id, (is_company + has_recent_activity + has_phone) / 3.0::DOUBLE + 0.05::DOUBLE AS score FROM features)
    SELECT account_id, CASE WHEN score > 0.7 THEN 1 ELSE 0 END AS high_propensity, CASE WHEN score > 0.7 THEN 'High' WHEN score > 0.5 THEN 'Medium' ELSE 'Low' END AS score_band FROM s""",
)
def _(crm):
    return E.score_bands(_scored(crm)).select("account_id", "high_propensity", "score_band")


def _scored(crm):
    """A fixed score, so that the lists built on it can be compared."""
    score = (F.col("is_company") + F.col("has_recent_activity") + F.col("has_phone")) / F.lit(3.0) + F.lit(0.05)
    return E.capacity_flag(crm.features).withColumn("score", score)


TOP = """WITH s AS (SELECT *, (is_company + has_recent_activity + has_phone) / 3.0::DOUBLE + 0.05::DOUBLE AS score, CASE WHEN is_company = 1 OR total_membership_fees > 500 THEN 1 ELSE 0 END AS cap FROM features),
t AS (SELECT * FROM s WHERE is_donor = 0 ORDER BY score DESC, account_id LIMIT 50),
c AS (SELECT account_id, score, concat_ws(', ', CASE WHEN has_active_membership = 1 THEN 'Member' END, CASE WHEN is_volunteer = 1 THEN 'Volunteer' END, CASE WHEN attends_events = 1 THEN 'Event Attendee' END,
  CASE WHEN is_company = 1 THEN 'Corporate' END, CASE WHEN cap = 1 THEN 'High Capacity' END) AS k,
  CAST(floor(CASE WHEN is_company = 1 THEN 250.0 WHEN total_membership_fees > 100 THEN greatest(50.0, total_membership_fees * 0.5) WHEN has_active_membership = 1 THEN 50.0 WHEN is_volunteer = 1 THEN 35.0 ELSE 25.0 END
    * CASE WHEN score > 0.8 THEN 1.5 ELSE 1.0 END) AS BIGINT) AS suggested_ask FROM t),
top AS (SELECT account_id, score, CASE WHEN k = '' THEN 'General Prospect' ELSE k END AS prospect_category, suggested_ask FROM c)
"""


@query("E11_top_prospects", TOP + "SELECT account_id, round(score, 9) AS score, prospect_category, suggested_ask FROM top")
def _(crm):
    best = E.top_prospects(_scored(crm)).select("account_id", "score", "prospect_category", "suggested_ask")
    return rounded(best, "score", digits=9)


@query(
    "A41_prospect_segments",
    TOP
    + """SELECT prospect_category, count(*) AS prospects, round(avg(score), 6) AS avg_score, CAST(sum(suggested_ask) AS DOUBLE) / count(*) AS avg_ask, CAST(sum(suggested_ask) AS BIGINT) AS total_ask,
      CAST(sum(suggested_ask) AS DOUBLE) * 0.15::DOUBLE AS estimated_revenue FROM top GROUP BY prospect_category""",
)
def _(crm):
    return rounded(A.prospect_segments(E.top_prospects(_scored(crm))), "avg_score")


@query(
    "A43_ask_ranges",
    TOP
    + """SELECT CASE WHEN suggested_ask <= 25 THEN '$0-25' WHEN suggested_ask <= 50 THEN '$25-50' WHEN suggested_ask <= 100 THEN '$50-100' WHEN suggested_ask <= 250 THEN '$100-250' ELSE '$250+' END AS ask_range, count(*) AS prospects FROM top GROUP BY 1""",
)
def _(crm):
    return A.ask_ranges(E.top_prospects(_scored(crm)))
