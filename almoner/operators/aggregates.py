"""Donor, campaign, membership, event and volunteer metrics.

Money stays decimal while it is summed and becomes double at the end. Every average is a sum
divided by a count in double, so results do not depend on how rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions.predicates import literal, op_not_blank
from almoner.functions.scalars import bucket, days_between, days_since, month_key, month_start
from almoner.operators.joins import flag_donors, match_campaigns
from almoner.operators.ranks import attach, exact_quantiles
from almoner.session import materialize
from almoner.sources.sinks import opportunity_count


def money(c: Column) -> Column:
    return F.sum(c).cast("double")


def mean_of(c: Column) -> Column:
    """Average of the non-null values as a double quotient; null without rows."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def safe_ratio(top: Column, bottom: Column, scale: float = 1.0) -> Column:
    """top / bottom * scale, and 0 when the denominator is 0 or missing."""
    quotient = F.try_divide(top.cast("double"), bottom.cast("double")) * scale
    return F.when(F.coalesce(bottom, F.lit(0)) == 0, 0.0).otherwise(quotient)


def rows() -> Column:
    return F.count(F.lit(1))


def share_of_total(df: DataFrame, column: str, out: str, scale: float = 100.0) -> DataFrame:
    """Add each row's share of the column total.

    `df` is an aggregate; it is materialized so that its input is read once and not once more for
    the total.
    """
    kept = materialize(df)
    held = attach(kept, kept.agg(F.sum(column).alias("t")), "__t")
    return held.withColumn(out, safe_ratio(F.col(column), F.col("__t")["t"], scale)).drop("__t")


def clean_gifts(donations: DataFrame) -> DataFrame:
    """Gifts with an account, a date and a positive amount."""
    return donations.dropna(subset=["account_id", "amount", "date"]).where(F.col("amount") > 0)


def donor_metrics(donations: DataFrame, as_of: datetime) -> DataFrame:
    grouped = donations.groupBy("account_id").agg(
        F.count("amount").alias("gift_count"),
        money(F.col("amount")).alias("total_donated"),
        mean_of(F.col("amount")).alias("avg_gift"),
        F.min("amount").cast("double").alias("min_gift"),
        F.max("amount").cast("double").alias("max_gift"),
        F.min("date").alias("first_gift"),
        F.max("date").alias("last_gift"),
        F.count("donation_id").alias("donation_count"),
    )
    return grouped.withColumn(
        "tenure_days", days_between(F.col("last_gift"), F.col("first_gift"))
    ).withColumn("days_since_last", days_since(F.col("last_gift"), as_of))


def exec_totals(donations: DataFrame) -> DataFrame:
    """Revenue, donors, gifts, average gift and revenue per donor.

    One row per donor first, so distinct donors need no second pass over the gifts.
    """
    per_donor = donations.groupBy("account_id").agg(
        F.sum("amount").alias("total"), F.count("amount").alias("gifts")
    )
    totals = per_donor.agg(
        money(F.col("total")).alias("total_revenue"),
        F.count("account_id").alias("total_donors"),
        F.sum("gifts").alias("total_gifts"),
    )
    return totals.withColumn(
        "avg_gift", safe_ratio(F.col("total_revenue"), F.col("total_gifts"))
    ).withColumn("revenue_per_donor", safe_ratio(F.col("total_revenue"), F.col("total_donors")))


def major_gifts(donations: DataFrame, q: float = 0.9) -> DataFrame:
    """Exact quantile threshold, the gifts at or above it, their sum and share."""
    held = attach(donations, exact_quantiles(donations, {"t": (F.col("amount"), q)}), "__q")
    threshold = F.col("__q")["t"]
    major = F.col("amount").cast("double") >= threshold
    out = held.agg(
        F.max(threshold).alias("threshold"),
        F.count_if(major).alias("major_gifts"),
        money(F.when(major, F.col("amount"))).alias("major_revenue"),
        money(F.col("amount")).alias("__all"),
    )
    share = safe_ratio(F.col("major_revenue"), F.col("__all"), 100.0)
    return out.withColumn("major_share", share).drop("__all")


def giving_frequency(metrics: DataFrame) -> DataFrame:
    n = F.col("gift_count")
    return metrics.agg(
        F.count_if(n == 1).alias("single_gift_donors"),
        F.count_if(n > 1).alias("multi_gift_donors"),
        safe_ratio(F.count_if(n > 1), rows(), 100.0).alias("repeat_rate"),
        mean_of(n).alias("avg_gifts"),
    )


def gift_count_histogram(metrics: DataFrame, top: int = 10) -> DataFrame:
    return metrics.where(F.col("gift_count") <= top).groupBy("gift_count").agg(rows().alias("donors"))


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Rows per non-null value with their share of all rows, largest first."""
    counts = materialize(df.groupBy(column).agg(rows().alias("count")))
    total = counts.agg(F.sum("count").alias("n"))
    shared = attach(counts.where(F.col(column).isNotNull()), total, "__t").withColumn(
        "share", safe_ratio(F.col("count"), F.col("__t")["n"], 100.0)
    )
    out = shared.drop("__t")
    return out if k is None else out.orderBy(F.desc("count"), F.asc(column)).limit(k)


def monthly_sum(donations: DataFrame) -> DataFrame:
    return donations.groupBy(month_start(F.col("date")).alias("month")).agg(
        money(F.col("amount")).alias("revenue")
    )


# Gift ranges with inclusive ends; amounts between two ranges belong to none.
GIFT_RANGES = (
    ("$1-50", 1, 50),
    ("$51-250", 51, 250),
    ("$251-1000", 251, 1000),
    ("$1001-5000", 1001, 5000),
)


def gift_buckets(donations: DataFrame) -> DataFrame:
    """Revenue per gift range; all five ranges are listed."""
    amount = F.col("amount")
    edges = [(amount.between(lo, hi), label) for label, lo, hi in GIFT_RANGES]
    edges.append((amount > 5000, "$5000+"))
    sums = [
        F.struct(
            F.lit(label).alias("gift_range"),
            F.coalesce(money(F.when(test, amount)), F.lit(0.0)).alias("revenue"),
        )
        for test, label in edges
    ]
    return donations.agg(F.array(*sums).alias("s")).select(F.inline("s"))


def avg_by_type(df: DataFrame, kind: str = "account_type", value: str = "avg_gift") -> DataFrame:
    return df.where(F.col(kind).isNotNull()).groupBy(kind).agg(mean_of(F.col(value)).alias("avg_value"))


def recency_bucket(days: Column) -> Column:
    return bucket(
        days,
        [
            ((days >= 0) & (days < 30), "0-30 days"),
            ((days >= 30) & (days < 90), "30-90 days"),
            ((days >= 90) & (days < 180), "90-180 days"),
            ((days >= 180) & (days < 365), "180-365 days"),
            ((days >= 365) & (days < 730), "1-2 years"),
            ((days >= 730) & (days < 1095), "2-3 years"),
            (days >= 1095, "3+ years"),
        ],
    )


def count_labels(df: DataFrame, label: Column, name: str, count: str = "count") -> DataFrame:
    """Rows per non-null label."""
    return df.select(label.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(rows().alias(count))


def recency_buckets(metrics: DataFrame) -> DataFrame:
    return count_labels(metrics, recency_bucket(F.col("days_since_last")), "recency", "donors")


def monthly_acquisition(donations: DataFrame) -> DataFrame:
    first = donations.groupBy("account_id").agg(F.min("date").alias("first_gift"))
    return first.groupBy(month_start(F.col("first_gift")).alias("month")).agg(rows().alias("new_donors"))


def lapsed_share(metrics: DataFrame, days: int = 365) -> DataFrame:
    lapsed = F.count_if(F.col("days_since_last") > days)
    return metrics.agg(
        rows().alias("donors"), lapsed.alias("lapsed"), safe_ratio(lapsed, rows(), 100.0).alias("lapsed_share")
    )


def top_share(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its share of all rows."""
    return value_counts(df, column, 1)


def parse_goal(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))


def campaign_performance(campaigns: DataFrame, donations: DataFrame) -> DataFrame:
    """Raised, donors, gifts, average and goal share per campaign, by id or name, zeros kept.

    Gifts are first reduced to one row per (campaign id, campaign name, donor), so a campaign that
    holds most gifts is spread over its donors before anything is joined.
    """
    reduced = donations.groupBy("campaign_id", "campaign_name", "account_id").agg(
        F.sum("amount").alias("raised"), rows().alias("gifts")
    )
    gifts = reduced.select(
        F.col("campaign_id").alias("d_id"), F.col("campaign_name").alias("d_name"), "account_id", "raised", "gifts"
    )
    per_donor = (
        match_campaigns(gifts, campaigns, "d_id", "d_name")
        .groupBy("campaign_id", "account_id")
        .agg(F.sum("raised").alias("raised"), F.sum("gifts").alias("gifts"))
    )
    per_campaign = per_donor.groupBy("campaign_id").agg(
        money(F.col("raised")).alias("total_raised"),
        F.count("account_id").alias("donor_count"),
        F.sum("gifts").alias("donation_count"),
    )
    zero = lambda name, value: F.coalesce(F.col(name), F.lit(value)).alias(name)
    joined = campaigns.join(per_campaign, "campaign_id", "left").select(
        "campaign_id",
        "campaign_name",
        parse_goal(F.col("goal")).alias("goal"),
        zero("total_raised", 0.0),
        zero("donor_count", 0),
        zero("donation_count", 0),
    )
    goal = F.col("goal")
    return joined.withColumn(
        "avg_donation", safe_ratio(F.col("total_raised"), F.col("donation_count"))
    ).withColumn(
        "goal_percentage",
        F.when(goal > 0, safe_ratio(F.col("total_raised"), goal, 100.0)).otherwise(0.0),
    )


def campaign_insights(performance: DataFrame) -> DataFrame:
    """One row over all campaigns: totals, best, most efficient, over, under and above mean."""
    efficiency = safe_ratio(F.col("total_raised"), F.col("donor_count"))
    rated = materialize(performance.withColumn("efficiency", efficiency))
    means = rated.agg(F.avg("efficiency").alias("m"))
    held = attach(rated, means, "__m")
    best = lambda c: F.max_by("campaign_name", F.struct(c, "campaign_name"))
    return held.agg(
        rows().alias("campaigns"),
        money(F.col("total_raised")).alias("total_revenue"),
        F.sum("goal").alias("total_goals"),
        F.avg("goal_percentage").alias("avg_goal_percentage"),
        F.sum("donor_count").alias("total_donors"),
        best("total_raised").alias("top_campaign"),
        best("efficiency").alias("most_efficient"),
        F.count_if(F.col("goal_percentage") > 110).alias("over_110"),
        F.count_if(F.col("goal_percentage") < 80).alias("under_80"),
        F.count_if(F.col("efficiency") > F.col("__m")["m"]).alias("above_mean_efficiency"),
    )


def goal_band(performance: DataFrame) -> DataFrame:
    pct = F.col("goal_percentage")
    return performance.withColumn(
        "goal_band", F.when(pct >= 100, "green").when(pct >= 80, "orange").otherwise("red")
    )


def donation_summary(donations: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return donations.agg(
        rows().alias("donations"),
        money(amount).alias("total"),
        mean_of(amount).alias("average"),
        F.max(amount).cast("double").alias("largest"),
        F.min(amount).cast("double").alias("smallest"),
    )


def size_buckets(donations: DataFrame) -> DataFrame:
    amount = F.col("amount")
    label = bucket(
        amount,
        [
            (amount <= 25, "<=25"),
            (amount <= 100, "<=100"),
            (amount <= 500, "<=500"),
            (amount <= 1000, "<=1000"),
            (amount > 1000, ">1000"),
        ],
    )
    counts = count_labels(donations, label, "size_bucket", "donations")
    return share_of_total(counts, "donations", "share")


def source_counts(donations: DataFrame, k: int = 5) -> DataFrame:
    return value_counts(donations, "source", k)


def pledge_totals(pledges: DataFrame) -> DataFrame:
    return pledges.agg(rows().alias("pledges"), money(F.col("amount")).alias("pledged"))


def campaign_totals(donations: DataFrame, min_amount: float) -> DataFrame:
    return (
        donations.where(F.col("amount") >= min_amount)
        .groupBy("campaign_name")
        .agg(rows().alias("gifts"), money(F.col("amount")).alias("total"))
    )


def recurring_summary(recurring: DataFrame) -> DataFrame:
    """Rows and active amount per status and frequency, with the two margins as extra rows."""
    active = F.lower("status") == "active"
    cells = recurring.groupBy("status", "frequency").agg(
        rows().alias("n"), F.sum(F.when(active, F.col("amount"))).alias("active")
    )
    parts = F.array(
        F.struct(F.lit("status").alias("dimension"), F.col("status").alias("value")),
        F.struct(F.lit("frequency").alias("dimension"), F.col("frequency").alias("value")),
        F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value")),
    )
    return (
        cells.select("n", "active", F.explode(parts).alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(
            F.sum("n").alias("recurring"),
            F.coalesce(money(F.col("active")), F.lit(0.0)).alias("active_amount"),
        )
    )


def registration_status(registrations: DataFrame) -> DataFrame:
    return value_counts(registrations, "status")


def event_summary(per_event: DataFrame) -> DataFrame:
    """Total and mean registrations and the most popular event."""
    return per_event.agg(
        rows().alias("events"),
        F.sum("registrations").alias("total_registrations"),
        mean_of(F.col("registrations")).alias("avg_registrations"),
        F.max_by("event_id", F.struct("registrations", "event_id")).alias("most_popular"),
    )


def with_active(memberships: DataFrame, as_of: datetime) -> DataFrame:
    """is_active: the term ends at or after `as_of`; without an end column everyone is active."""
    if "term_end" not in memberships.columns:
        return memberships.withColumn("is_active", F.lit(True))
    return memberships.withColumn(
        "is_active", F.coalesce(F.col("term_end") >= literal(as_of), F.lit(False))
    )


def membership_summary(memberships: DataFrame, as_of: datetime) -> DataFrame:
    """Memberships, active ones, members and fees; one row per member first."""
    per_member = (
        with_active(memberships, as_of)
        .groupBy("account_id")
        .agg(
            rows().alias("n"),
            F.count_if(F.col("is_active")).alias("active"),
            F.sum("fee").alias("fees"),
        )
    )
    return per_member.agg(
        F.sum("n").alias("memberships"),
        F.sum("active").alias("active_memberships"),
        F.count("account_id").alias("members"),
        money(F.col("fees")).alias("fee_total"),
    )


def membership_retention(memberships: DataFrame, as_of: datetime) -> DataFrame:
    """Total, active and active share per level, with an overall row from the same pass."""
    overall = F.grouping("level") == 1
    both = (
        with_active(memberships, as_of)
        .rollup("level")
        .agg(
            overall.alias("overall"),
            rows().alias("total"),
            F.count_if(F.col("is_active")).alias("active"),
        )
        .where(F.col("overall") | F.col("level").isNotNull())
    )
    return both.select(
        F.when(F.col("overall"), "(all)").otherwise(F.col("level")).alias("level"),
        "total",
        "active",
        safe_ratio(F.col("active"), F.col("total"), 100.0).alias("retention_rate"),
    )


def level_revenue(memberships: DataFrame) -> DataFrame:
    fee = F.col("fee")
    per_level = (
        memberships.where(F.col("level").isNotNull())
        .groupBy("level")
        .agg(money(fee).alias("revenue"), mean_of(fee).alias("avg_fee"), F.count(fee).alias("memberships"))
    )
    return share_of_total(per_level, "revenue", "revenue_share")


def expiry_category(days: Column) -> Column:
    return bucket(
        days,
        [
            (days <= 0, "Expired"),
            (days <= 30, "0-30 days"),
            (days <= 90, "31-90 days"),
            (days <= 180, "91-180 days"),
            (days <= 365, "181-365 days"),
            (days > 365, "365+ days"),
        ],
    )


def days_to_expiry(as_of: datetime) -> Column:
    return days_between(F.col("term_end"), literal(as_of))


def expiry_distribution(memberships: DataFrame, as_of: datetime) -> DataFrame:
    days = days_to_expiry(as_of)
    return (
        memberships.select(expiry_category(days).alias("expiry"), ((days > 0) & (days <= 30)).alias("risk"))
        .where(F.col("expiry").isNotNull())
        .groupBy("expiry")
        .agg(rows().alias("memberships"), F.count_if(F.col("risk")).alias("at_risk"))
    )


def enrolment_series(memberships: DataFrame, grain: str = "month") -> DataFrame:
    """Enrolments and fee revenue per month or year of the transaction date."""
    date = F.col("transaction_date")
    period = month_start(date) if grain == "month" else F.trunc(date, "year")
    return (
        memberships.where(date.isNotNull())
        .groupBy(period.alias("period"))
        .agg(rows().alias("enrolments"), money(F.col("fee")).alias("revenue"))
    )


def enrolment_trend(series: DataFrame) -> DataFrame:
    """Straight-line fit of enrolments over the month index; `series` has one row per month."""
    indexed = series.withColumn(
        "x", (F.row_number().over(Window.orderBy("period")) - 1).cast("double")
    ).withColumn("y", F.col("enrolments").cast("double"))
    return indexed.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
        rows().alias("months"),
        mean_of(F.col("enrolments")).alias("avg_per_month"),
        F.max_by("period", F.struct("enrolments", F.negative(F.unix_date("period")))).alias("peak_month"),
        F.max("enrolments").alias("peak_enrolments"),
        F.sum("enrolments").alias("total_enrolments"),
    )


def volunteer_kpis(
    volunteers: DataFrame,
    individual: Sequence[str] = ("INDIVIDUAL", "Individual"),
    organisation: Sequence[str] = ("Organization", "COMPANY"),
) -> DataFrame:
    """Volunteers, participation rates, account kinds and opportunity counts in one pass."""
    has_opp = op_not_blank(F.col("assigned_opportunities"))
    has_group = op_not_blank(F.col("volunteer_group"))
    count = opportunity_count(F.col("assigned_opportunities"))
    return volunteers.agg(
        rows().alias("total_volunteers"),
        F.count_if(has_opp).alias("with_opportunities"),
        F.count_if(has_group).alias("with_groups"),
        safe_ratio(F.count_if(has_opp), rows(), 100.0).alias("opportunity_rate"),
        safe_ratio(F.count_if(has_group), rows(), 100.0).alias("group_rate"),
        F.count_if(F.col("account_type").isin(*individual)).alias("individuals"),
        F.count_if(F.col("account_type").isin(*organisation)).alias("organisations"),
        F.sum(count).alias("total_opportunities"),
        safe_ratio(F.sum(count), F.count_if(has_opp)).alias("avg_opportunities"),
        F.max(count).alias("max_opportunities"),
    )


def opportunity_stats(volunteers: DataFrame) -> DataFrame:
    return volunteer_kpis(volunteers).select(
        "total_opportunities", "avg_opportunities", "max_opportunities"
    )


def dimension_counts(df: DataFrame, dimensions: Sequence[str], k: int) -> DataFrame:
    """Top k non-empty values of each dimension, counted in one pass.

    Counts are combined per (dimension, value) before the ranking, which keeps k rows per task.
    """
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]
    )
    counts = (
        df.select(F.explode(pairs).alias("p"))
        .where(op_not_blank(F.col("p.value")))
        .groupBy("p.dimension", "p.value")
        .agg(rows().alias("count"))
    )
    order = Window.partitionBy("dimension").orderBy(F.desc("count"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def group_summary(exported: DataFrame) -> DataFrame:
    return (
        exported.where(op_not_blank(F.col("volunteer_group")))
        .groupBy("volunteer_group")
        .agg(
            F.count("account_id").alias("total_volunteers"),
            F.sum("opportunity_count").alias("total_opportunities"),
            F.sum("is_active_participant").alias("active_participants"),
            mean_of(F.col("participation_score")).alias("avg_participation_score"),
        )
    )


def participation_distribution(exported: DataFrame) -> DataFrame:
    score = F.col("participation_score")
    label = (
        F.when(score == 0, "No Participation")
        .when(score == 1, "Low Participation")
        .when(score == 2, "Moderate Participation")
        .otherwise("High Participation")
    )
    return exported.groupBy("participation_score").agg(rows().alias("volunteers")).withColumn("label", label)


def opportunity_distribution(exported: DataFrame) -> DataFrame:
    return (
        exported.where(F.col("opportunity_count") > 0)
        .groupBy("opportunity_count")
        .agg(rows().alias("volunteers"))
    )


def program_status(programs: dict[str, DataFrame]) -> DataFrame:
    """Active flag and rows per program, and the share of programs in use."""
    counted = [
        frame.agg(rows().alias("count")).select(F.lit(name).alias("program"), "count")
        for name, frame in programs.items()
    ]
    stacked = counted[0]
    for frame in counted[1:]:
        stacked = stacked.unionByName(frame)
    status = materialize(stacked.withColumn("active", F.col("count") > 0))
    used = status.agg(safe_ratio(F.count_if(F.col("active")), rows(), 100.0).alias("u"))
    return attach(status, used, "__u").select("program", "count", "active", F.col("__u")["u"].alias("utilisation"))


def program_distributions(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows per value of each dimension; missing values count as Unknown."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("Unknown")).alias("value")
            )
            for d in dimensions
        ]
    )
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(rows().alias("count"))


def donation_program(donations: DataFrame) -> DataFrame:
    """Count, total and mean overall and by campaign, fund (default General Fund) and month key."""
    cells = donations.groupBy(
        F.coalesce("campaign_name", F.lit("Unknown")).alias("campaign"),
        F.coalesce("fund", F.lit("General Fund")).alias("fund"),
        month_key(F.col("date")).alias("month"),
    ).agg(rows().alias("n"), F.sum("amount").alias("amount"))
    parts = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in ("campaign", "fund", "month")],
        F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value")),
    )
    return (
        cells.select("n", "amount", F.explode(parts).alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(F.sum("n").alias("donations"), money(F.col("amount")).alias("total"))
        .withColumn("average", safe_ratio(F.col("total"), F.col("donations")))
    )


def donor_percentage(accounts: DataFrame, donations: DataFrame) -> DataFrame:
    flagged = flag_donors(accounts, donations)
    donors = F.count_if(F.col("is_donor"))
    return flagged.agg(
        rows().alias("accounts"), donors.alias("donors"), safe_ratio(donors, rows(), 100.0).alias("donor_percentage")
    )


def geographic_reach(programs: dict[str, DataFrame], state: str = "state", approx: bool = False) -> DataFrame:
    """Distinct states per program."""
    count = F.approx_count_distinct if approx else F.count_distinct
    out = None
    for name, frame in programs.items():
        reach = frame.agg(count(state).alias("states")).select(F.lit(name).alias("program"), "states")
        out = reach if out is None else out.unionByName(reach)
    return out


# Metrics compared between donors and other accounts.
CONTRAST_METRICS = (
    "engagement_score",
    "attends_events",
    "has_active_membership",
    "is_volunteer",
    "contact_completeness",
    "account_age_years",
    "has_recent_activity",
)


def donor_contrast(features: DataFrame, metrics: Sequence[str] = CONTRAST_METRICS) -> DataFrame:
    """Mean of each metric for donors and others, and the difference; 0 for an empty side."""
    donor = F.col("is_donor") == 1
    means = [
        F.struct(
            F.lit(m).alias("metric"),
            F.coalesce(F.avg(F.when(donor, F.col(m).cast("double"))), F.lit(0.0)).alias("donors"),
            F.coalesce(F.avg(F.when(~donor, F.col(m).cast("double"))), F.lit(0.0)).alias("others"),
        )
        for m in metrics
        if m in features.columns
    ]
    return (
        features.agg(F.array(*means).alias("s"))
        .select(F.inline("s"))
        .withColumn("difference", F.col("donors") - F.col("others"))
    )


def type_analysis(features: DataFrame) -> DataFrame:
    return (
        features.where(F.col("account_type").isNotNull())
        .groupBy("account_type")
        .agg(
            rows().alias("accounts"),
            F.sum("is_donor").alias("donors"),
            mean_of(F.col("is_donor")).alias("donor_rate"),
            F.sum("is_major_donor").alias("major_donors"),
            mean_of(F.col("lifetime_donation_amount")).alias("avg_lifetime"),
        )
    )


def prime_prospects(features: DataFrame) -> DataFrame:
    other = F.col("is_donor") == 0
    return features.agg(
        F.count_if(other & (F.col("high_engagement") == 1)).alias("high_engagement"),
        F.count_if(other & (F.col("has_active_membership") == 1)).alias("members"),
        F.count_if(other & (F.col("is_volunteer") == 1)).alias("volunteers"),
        F.count_if(other & (F.col("attends_events") == 1)).alias("attendees"),
    )


def prospect_segments(prospects: DataFrame, conversion: float = 0.15) -> DataFrame:
    """Count, mean score and ask per prospect category, with the total ask and expected revenue."""
    per_segment = prospects.groupBy("prospect_category").agg(
        rows().alias("prospects"),
        F.avg("score").alias("avg_score"),
        mean_of(F.col("suggested_ask")).alias("avg_ask"),
        F.sum("suggested_ask").alias("total_ask"),
    )
    return per_segment.withColumn("estimated_revenue", F.col("total_ask") * conversion)


def rate_by_factor(features: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Donor share with and without each 0/1 factor."""
    donor = F.col("is_donor").cast("double")
    rates = [
        F.struct(
            F.lit(f).alias("factor"),
            F.avg(F.when(F.col(f) == 1, donor)).alias("rate_with"),
            F.avg(F.when(F.col(f) == 0, donor)).alias("rate_without"),
        )
        for f in factors
    ]
    return features.agg(F.array(*rates).alias("s")).select(F.inline("s"))


def ask_ranges(prospects: DataFrame) -> DataFrame:
    ask = F.col("suggested_ask")
    label = bucket(
        ask,
        [
            ((ask > 0) & (ask <= 25), "$0-25"),
            ((ask > 25) & (ask <= 50), "$25-50"),
            ((ask > 50) & (ask <= 100), "$50-100"),
            ((ask > 100) & (ask <= 250), "$100-250"),
            (ask > 250, "$250+"),
        ],
    )
    return count_labels(prospects, label, "ask_range", "prospects")


def field_type_inventory(custom_fields: DataFrame, first: int = 3) -> DataFrame:
    """Fields per data type with the first few names in order.

    Names are cut to the first few per type by rank before they are put in a list.
    """
    kind = F.coalesce("data_type", F.lit("Unknown"))
    typed = custom_fields.select(kind.alias("data_type"), "name")
    order = Window.partitionBy("data_type").orderBy("name")
    names = (
        typed.distinct()
        .withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= first)
        .groupBy("data_type")
        .agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("examples"))
    )
    counts = typed.groupBy("data_type").agg(rows().alias("fields"))
    return counts.join(names, "data_type", "left")


def name_length_stats(df: DataFrame, name: str = "name") -> DataFrame:
    """Mean, median, shortest and longest name; the median keeps one entry per distinct length."""
    size = F.length(name)
    return df.agg(
        mean_of(size).alias("avg_length"),
        F.median(size).alias("median_length"),
        F.min(size).alias("min_length"),
        F.max(size).alias("max_length"),
        F.min_by(name, F.struct(F.negative(size), name)).alias("longest"),
        F.min_by(name, F.struct(size, name)).alias("shortest"),
    )
