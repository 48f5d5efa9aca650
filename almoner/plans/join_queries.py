"""Queries on joins and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import joins as J
from almoner.plans.registry import query
from almoner.plans.standins import AS_OF  # noqa: F401


@query(
    "J1_children",
    """SELECT donation_id, account_id FROM donations WHERE account_id IN (SELECT account_id FROM accounts WHERE country = 'EUROPE')""",
)
def _(crm):
    parents = crm.accounts.where(F.col("country") == "EUROPE")
    return J.children(crm.donations.select("donation_id", "account_id"), parents, "account_id")


@query(
    "J2_memberships_for",
    """SELECT account_id, level, count(*) AS n FROM memberships
      WHERE account_id IN (SELECT account_id FROM accounts WHERE user_type = 'COMPANY') GROUP BY ALL""",
)
def _(crm):
    companies = crm.accounts.where(F.col("user_type") == "COMPANY")
    return J.memberships_for(companies, crm.memberships).groupBy("account_id", "level").agg(F.count("*").alias("n"))


@query(
    "J3_donor_accounts",
    "SELECT account_id, state FROM accounts WHERE account_id IN (SELECT account_id FROM donations WHERE date >= TIMESTAMP '2001-05-01')",
)
def _(crm):
    recent = crm.donations.where(F.col("date") >= F.lit("2001-05-01").cast("timestamp_ntz"))
    return J.donor_accounts(crm.accounts.select("account_id", "state"), recent)


@query(
    "J4_with_profile",
    """SELECT r.account_id, r.frequency, a.account_type, a.state FROM rfm r LEFT JOIN
      (SELECT * FROM accounts WHERE balance > 0) a ON a.account_id = r.account_id""",
)
def _(crm):
    profile = crm.accounts.where(F.col("balance") > 0).select("account_id", "account_type", "state")
    return J.with_profile(crm.rfm.select("account_id", "frequency"), profile)


@query(
    "J5_campaign_join",
    """SELECT c.campaign_id, c.campaign_name, d.donation_id, d.status FROM campaigns c
      LEFT JOIN donations d ON c.campaign_id = d.campaign_id OR c.campaign_name = d.campaign_name""",
)
def _(crm):
    gifts = crm.donations.select(
        "donation_id",
        "status",
        F.col("campaign_id").alias("donation_campaign_id"),
        F.col("campaign_name").alias("donation_campaign_name"),
    )
    return J.campaign_join(crm.campaigns.select("campaign_id", "campaign_name"), gifts).select(
        "campaign_id", "campaign_name", "donation_id", "status"
    )


def _chunks(crm):
    """Three column chunks of accounts: the second lacks some keys and holds phantom ones."""
    a = crm.accounts
    first = a.where(F.col("balance") < 9000).select("account_id", "first_name", "email", F.lit(1).alias("seq"))
    second = a.where(F.col("balance") > 100).select(
        "account_id", F.when(F.col("balance") > 500, F.upper("email")).alias("email"), "state", F.lit(1).alias("seq")
    )
    third = crm.donations.select("account_id", F.col("source").alias("last_source"), F.col("donation_id").alias("seq"))
    return [first, second, third]


@query(
    "J6_merge_column_chunks",
    """WITH last AS (SELECT account_id, source FROM donations QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY donation_id DESC) = 1)
    SELECT a.account_id, a.first_name,
      CASE WHEN b.account_id IS NULL THEN a.email WHEN b.balance > 500 THEN upper(b.email) END AS email,
      b.state, last.source AS last_source
    FROM (SELECT * FROM accounts WHERE balance < 9000) a
      LEFT JOIN (SELECT * FROM accounts WHERE balance > 100) b ON a.account_id = b.account_id
      LEFT JOIN last ON last.account_id = a.account_id""",
)
def _(crm):
    return J.merge_column_chunks(_chunks(crm), "account_id", "seq")


@query(
    "J7_chunk_consistency",
    """WITH c0 AS (SELECT account_id FROM accounts WHERE balance < 9000), c1 AS (SELECT account_id FROM accounts WHERE balance > 100),
      c2 AS (SELECT DISTINCT account_id FROM donations)
    SELECT 0 AS chunk, (SELECT count(*) FROM c0) AS chunk_size, 0 AS phantom, 0 AS missing
    UNION ALL SELECT 1, (SELECT count(*) FROM c1), (SELECT count(*) FROM c1 WHERE account_id NOT IN (FROM c0)), (SELECT count(*) FROM c0 WHERE account_id NOT IN (FROM c1))
    UNION ALL SELECT 2, (SELECT count(*) FROM c2), (SELECT count(*) FROM c2 WHERE account_id NOT IN (FROM c0)), (SELECT count(*) FROM c0 WHERE account_id NOT IN (FROM c2))""",
)
def _(crm):
    return J.chunk_consistency(_chunks(crm), "account_id")


@query(
    "J8_merge_sources",
    """SELECT a.account_id, coalesce(CASE WHEN trim(a.last_name) <> '' THEN a.last_name END, b.n) AS last_name,
      coalesce(a.email, b.e) AS email, b.role FROM accounts a LEFT JOIN
      (SELECT account_id, min('n' || account_id) AS n, min('vol' || account_id) AS e, min(CASE WHEN volunteer_role <> '' THEN volunteer_role END) AS role FROM volunteers GROUP BY account_id) b
      ON a.account_id = b.account_id""",
)
def _(crm):
    people = crm.accounts.select("account_id", "last_name", "email")
    helpers = crm.volunteers.select(
        "account_id",
        F.concat(F.lit("n"), "account_id").alias("last_name"),
        F.concat(F.lit("vol"), "account_id").alias("email"),
        F.col("volunteer_role").alias("role"),
    )
    return J.merge_sources([people, helpers], "account_id")


@query(
    "J9_append_missing",
    """SELECT account_id, balance FROM accounts WHERE balance > 5000 UNION ALL
      SELECT s_suppkey * 10, s_acctbal FROM supplier WHERE s_suppkey * 10 NOT IN (SELECT account_id FROM accounts WHERE balance > 5000)""",
)
def _(crm):
    rich = crm.accounts.where(F.col("balance") > 5000).select("account_id", "balance")
    firms = crm.table("supplier").select((F.col("s_suppkey") * 10).alias("account_id"), F.col("s_acctbal").alias("balance"))
    return J.append_missing(rich, firms, "account_id")


@query(
    "J10_flag_donors",
    """SELECT account_id, account_id IN (SELECT account_id FROM donations WHERE date >= TIMESTAMP '2001-01-01') AS is_donor FROM accounts""",
)
def _(crm):
    recent = crm.donations.where(F.col("date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return J.flag_donors(crm.accounts.select("account_id"), recent)


@query(
    "J11_registrations_per_event",
    """SELECT e.event_id, count(r.registration_id) AS registrations FROM crm_events e LEFT JOIN registrations r
      ON r.event_id = e.event_id GROUP BY e.event_id""",
)
def _(crm):
    return J.registrations_per_event(crm.crm_events, crm.registrations)


@query(
    "J12_year_pairs",
    """WITH y AS (SELECT DISTINCT account_id, CAST(year(date) AS INTEGER) AS year FROM donations),
      n AS (SELECT year, lead(year) OVER (ORDER BY year) AS next_year FROM (SELECT DISTINCT year FROM y))
    SELECT a.account_id, a.year, n.next_year FROM y a JOIN n ON n.year = a.year
      JOIN y b ON b.account_id = a.account_id AND b.year = n.next_year""",
)
def _(crm):
    return J.year_pairs(crm.donations)
