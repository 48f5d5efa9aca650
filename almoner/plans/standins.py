"""The driver's tables seen as CRM resources, once as DataFrames and once as SQL.

Both sides are written out by hand, so the SQL checks the stand-ins as well as the operators.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.session import materialize

AS_OF = datetime(2001, 8, 2)
AS_OF_EVENTS = datetime(2024, 1, 31)
DONATION_YEARS = tuple(range(1995, 2002))

PRELUDE = """WITH RECURSIVE donations AS (
  SELECT o_orderkey AS donation_id, o_custkey AS account_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS date,
    CASE WHEN o_orderstatus <> 'P' THEN substr(o_orderpriority, 1, 1) END AS campaign_id,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS campaign_name,
    CASE WHEN o_orderstatus <> 'P' THEN 'Fund ' || o_orderstatus END AS fund,
    o_orderpriority AS source, o_orderstatus AS status
  FROM orders),
gifts AS (SELECT * FROM donations WHERE amount > 0 AND account_id IS NOT NULL AND date IS NOT NULL),
accounts AS (
  SELECT c_custkey AS account_id, split_part(c_name, '#', 1) AS first_name,
    CASE WHEN c_acctbal < 0 THEN '' ELSE split_part(c_name, '#', 2) END AS last_name,
    c_mktsegment AS account_type,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'COMPANY' ELSE 'INDIVIDUAL' END AS user_type,
    c_acctbal AS balance,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN replace(lower(c_name), '#', '.')
      ELSE replace(lower(c_name), '#', '.') || '@example.org' END AS email,
    CASE WHEN c_acctbal <= 5000 THEN '+1' || split_part(c_name, '#', 2) END AS phone,
    CASE WHEN c_acctbal >= 500 THEN 'City ' || CAST(c_nationkey AS VARCHAR) END AS city,
    n_name AS state, r_name AS country,
    CAST(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 5) AS INTEGER) AS TIMESTAMP) AS created,
    CAST(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 5) AS INTEGER) + 400 AS TIMESTAMP) AS modified
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey),
campaigns AS (
  SELECT substr(o_orderpriority, 1, 1) AS campaign_id, o_orderpriority AS campaign_name,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '400000000' WHEN '2' THEN '700000000'
      WHEN '3' THEN '' WHEN '4' THEN 'open' ELSE '900000000' END AS goal,
    CASE WHEN substr(o_orderpriority, 1, 1) < '4' THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
    CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'Annual' ELSE 'Appeal' END AS type
  FROM (SELECT DISTINCT o_orderpriority FROM orders) AS p
  UNION ALL SELECT '9', 'Dormant', '1000', 'INACTIVE', 'Appeal'),
memberships AS (
  SELECT l_suppkey AS account_id, CASE WHEN l_returnflag <> 'N' THEN 'Level ' || l_returnflag END AS level,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS fee,
    l_shipdate - INTERVAL 365 DAY AS transaction_date, l_shipdate - INTERVAL 365 DAY AS term_start,
    CASE WHEN l_linenumber < 7 THEN l_shipdate END AS term_end, l_linestatus AS status,
    l_linenumber AS type_id, l_orderkey AS order_id
  FROM lineitem),
volunteers AS (
  SELECT event_id AS volunteer_id, user_id AS account_id,
    CASE WHEN event_type <> 'error' THEN 'Team ' || event_type END AS volunteer_group,
    CASE WHEN value >= 20 THEN event_type ELSE '' END AS volunteer_role,
    CASE WHEN value >= 100 THEN event_type || ', training, , mentoring'
      WHEN value >= 30 THEN event_type || ',training' WHEN value >= 10 THEN event_type END
      AS assigned_opportunities,
    CASE WHEN value < 50 THEN 'INDIVIDUAL' ELSE 'Organization' END AS kind,
    CASE WHEN value < 25 THEN 'ACTIVE' ELSE 'PAUSED' END AS status
  FROM events),
volunteer_rows AS (
  SELECT v.*, v.kind AS account_type, a.city, a.state
  FROM volunteers v LEFT JOIN accounts a ON a.account_id = v.account_id),
registrations AS (
  SELECT event_id AS registration_id, event_type AS event_id, user_id AS account_id,
    CASE WHEN value < 10 THEN 'CANCELED' WHEN value < 50 THEN 'SUCCEEDED' ELSE 'DEFERRED' END AS status,
    ts AS registered
  FROM events),
crm_events AS (
  SELECT DISTINCT event_type AS event_id FROM events UNION ALL SELECT 'gala'),
recurring AS (
  SELECT o_orderkey AS recurring_id, o_custkey AS account_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'ACTIVE' ELSE 'Canceled' END AS status,
    o_orderpriority AS frequency, substr(o_orderpriority, 1, 1) AS campaign_id, o_orderdate AS start_date
  FROM orders),
custom_fields AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS component, p_type AS group_name,
    CASE p_type WHEN 'STANDARD' THEN 'Text' WHEN 'PROMO' THEN 'Integer' WHEN 'LARGE' THEN 'Date' END AS data_type,
    CASE WHEN p_size < 20 THEN 'DropDown' ELSE 'OneLineText' END AS display_type
  FROM part),
rfm AS (
  SELECT account_id, max(date) AS last_gift, count(donation_id) AS frequency,
    CAST(sum(amount) AS DOUBLE) AS total_donated, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_donation,
    coalesce(stddev_samp(CAST(amount AS DOUBLE)), 0.0) AS donation_std,
    CAST(min(amount) AS DOUBLE) AS min_donation, CAST(max(amount) AS DOUBLE) AS max_donation,
    min(date) AS first_gift,
    date_diff('day', CAST(max(date) AS DATE), DATE '2001-08-02') AS recency_days,
    date_diff('day', CAST(min(date) AS DATE), CAST(max(date) AS DATE)) AS tenure_days
  FROM gifts GROUP BY account_id),
features AS (
  SELECT a.account_id, a.account_type,
    coalesce(g.amount, 0.0) AS lifetime_donation_amount, coalesce(g.n, 0) AS donation_count,
    CASE WHEN g.n > 0 THEN 1 ELSE 0 END AS is_donor, CASE WHEN g.amount >= 300000 THEN 1 ELSE 0 END AS is_major_donor,
    CASE WHEN a.user_type = 'COMPANY' THEN 1 ELSE 0 END AS is_company,
    CASE WHEN a.email IS NULL THEN 0 ELSE 1 END AS has_email, CASE WHEN a.phone IS NULL THEN 0 ELSE 1 END AS has_phone,
    CASE WHEN a.city IS NULL AND a.state IS NULL AND a.country IS NULL THEN 0 ELSE 1 END AS has_address,
    coalesce(e.n, 0) AS events_attended, CASE WHEN e.n > 0 THEN 1 ELSE 0 END AS attends_events,
    CASE WHEN e.v > 0 THEN 1 ELSE 0 END AS is_volunteer,
    coalesce(m.n, 0) AS membership_count, coalesce(m.fees, 0.0) AS total_membership_fees,
    CASE WHEN m.n > 0 THEN 1 ELSE 0 END AS has_active_membership,
    CAST(date_diff('day', a.created, TIMESTAMP '2001-08-02') AS DOUBLE) / 365.25 AS account_age_years,
    CASE WHEN date_diff('day', a.modified, TIMESTAMP '2001-08-02') <= 180 THEN 1 ELSE 0 END AS has_recent_activity
  FROM accounts a
  LEFT JOIN (SELECT account_id, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n FROM donations
    WHERE date >= TIMESTAMP '2001-01-01' GROUP BY account_id) g ON g.account_id = a.account_id
  LEFT JOIN (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE value >= 100) AS v FROM events
    GROUP BY user_id) e ON e.user_id = a.account_id
  LEFT JOIN (SELECT account_id, CAST(sum(fee) AS DOUBLE) / 1000000 AS fees, count(*) AS n FROM memberships
    WHERE term_end >= TIMESTAMP '2001-08-02' GROUP BY account_id) m ON m.account_id = a.account_id)"""


class Crm:
    """Stand-in resources over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def donations(self) -> DataFrame:
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("donation_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.col("o_orderdate").alias("date"),
            F.when(status != "P", F.substring(priority, 1, 1)).alias("campaign_id"),
            F.when(status != "O", priority).alias("campaign_name"),
            F.when(status != "P", F.concat(F.lit("Fund "), status)).alias("fund"),
            priority.alias("source"),
            status.alias("status"),
        )

    @cached_property
    def gifts(self) -> DataFrame:
        from almoner.operators.aggregates import clean_gifts

        return clean_gifts(self.donations)

    @cached_property
    def accounts(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
        slug = F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))
        number = F.split_part("c_name", F.lit("#"), F.lit(2))
        offset = F.floor(F.abs(balance) / 5).cast("int")
        created = F.date_add(F.lit("1995-01-01").cast("date"), offset)
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("c_custkey").alias("account_id"),
                F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                F.when(balance < 0, "").otherwise(number).alias("last_name"),
                segment.alias("account_type"),
                F.when(segment.isin("MACHINERY", "BUILDING"), "COMPANY")
                .otherwise("INDIVIDUAL")
                .alias("user_type"),
                balance.alias("balance"),
                F.when(balance >= 1000, F.concat(slug, F.lit("@example.org")))
                .when(balance >= 0, slug)
                .alias("email"),
                F.when(balance <= 5000, F.concat(F.lit("+1"), number)).alias("phone"),
                F.when(balance >= 500, F.concat(F.lit("City "), F.col("c_nationkey"))).alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
                created.cast("timestamp_ntz").alias("created"),
                F.date_add(created, 400).cast("timestamp_ntz").alias("modified"),
            )
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        code = F.substring("o_orderpriority", 1, 1)
        real = (
            self.table("orders")
            .select("o_orderpriority")
            .distinct()
            .select(
                code.alias("campaign_id"),
                F.col("o_orderpriority").alias("campaign_name"),
                F.when(code == "1", "400000000")
                .when(code == "2", "700000000")
                .when(code == "3", "")
                .when(code == "4", "open")
                .otherwise("900000000")
                .alias("goal"),
                F.when(code < "4", "ACTIVE").otherwise("INACTIVE").alias("status"),
                F.when(code == "1", "Annual").otherwise("Appeal").alias("type"),
            )
        )
        dormant = self.spark.createDataFrame(
            [("9", "Dormant", "1000", "INACTIVE", "Appeal")], real.schema
        )
        # a handful of rows that would otherwise be found again for every use
        return materialize(real.unionByName(dormant))

    @cached_property
    def memberships(self) -> DataFrame:
        year = F.make_dt_interval(F.lit(365))
        ship = F.col("l_shipdate")
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("account_id"),
            F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Level "), "l_returnflag")).alias("level"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("fee"),
            (ship - year).alias("transaction_date"),
            (ship - year).alias("term_start"),
            F.when(F.col("l_linenumber") < 7, ship).alias("term_end"),
            F.col("l_linestatus").alias("status"),
            F.col("l_linenumber").alias("type_id"),
            F.col("l_orderkey").alias("order_id"),
        )

    @cached_property
    def volunteers(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return self.table("events").select(
            F.col("event_id").alias("volunteer_id"),
            F.col("user_id").alias("account_id"),
            F.when(kind != "error", F.concat(F.lit("Team "), kind)).alias("volunteer_group"),
            F.when(value >= 20, kind).otherwise("").alias("volunteer_role"),
            F.when(value >= 100, F.concat(kind, F.lit(", training, , mentoring")))
            .when(value >= 30, F.concat(kind, F.lit(",training")))
            .when(value >= 10, kind)
            .alias("assigned_opportunities"),
            F.when(value < 50, "INDIVIDUAL").otherwise("Organization").alias("kind"),
            F.when(value < 25, "ACTIVE").otherwise("PAUSED").alias("status"),
        )

    @cached_property
    def volunteer_rows(self) -> DataFrame:
        places = self.accounts.select("account_id", "city", "state")
        return self.volunteers.join(places, "account_id", "left").withColumn("account_type", F.col("kind"))

    @cached_property
    def registrations(self) -> DataFrame:
        value = F.col("value")
        return self.table("events").select(
            F.col("event_id").alias("registration_id"),
            F.col("event_type").alias("event_id"),
            F.col("user_id").alias("account_id"),
            F.when(value < 10, "CANCELED").when(value < 50, "SUCCEEDED").otherwise("DEFERRED").alias("status"),
            F.col("ts").alias("registered"),
        )

    @cached_property
    def crm_events(self) -> DataFrame:
        real = self.table("events").select(F.col("event_type").alias("event_id")).distinct()
        return real.unionByName(self.spark.createDataFrame([("gala",)], real.schema))

    @cached_property
    def recurring(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("recurring_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.when(status == "F", "Active").when(status == "O", "ACTIVE").otherwise("Canceled").alias("status"),
            F.col("o_orderpriority").alias("frequency"),
            F.substring("o_orderpriority", 1, 1).alias("campaign_id"),
            F.col("o_orderdate").alias("start_date"),
        )

    @cached_property
    def custom_fields(self) -> DataFrame:
        kind = F.col("p_type")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("component"),
            kind.alias("group_name"),
            F.when(kind == "STANDARD", "Text").when(kind == "PROMO", "Integer").when(kind == "LARGE", "Date").alias("data_type"),
            F.when(F.col("p_size") < 20, "DropDown").otherwise("OneLineText").alias("display_type"),
        )

    @cached_property
    def rfm(self) -> DataFrame:
        from almoner.operators.segments import rfm_metrics

        return rfm_metrics(self.gifts, AS_OF)

    @cached_property
    def features(self) -> DataFrame:
        """One row per account with giving since 2001, events and active memberships."""
        one = lambda test: F.coalesce(test, F.lit(False)).cast("int")
        given = (
            self.donations.where(F.col("date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
            .groupBy("account_id")
            .agg(F.sum("amount").cast("double").alias("g_amount"), F.count("*").alias("g_n"))
        )
        seen = (
            self.table("events")
            .groupBy(F.col("user_id").alias("account_id"))
            .agg(F.count("*").alias("e_n"), F.count_if(F.col("value") >= 100).alias("e_v"))
        )
        active = (
            self.memberships.where(F.col("term_end") >= F.lit(str(AS_OF)).cast("timestamp_ntz"))
            .groupBy("account_id")
            .agg((F.sum("fee").cast("double") / 1000000).alias("m_fees"), F.count("*").alias("m_n"))
        )
        today = F.lit(str(AS_OF)).cast("timestamp_ntz")
        return (
            self.accounts.join(given, "account_id", "left")
            .join(seen, "account_id", "left")
            .join(active, "account_id", "left")
            .select(
                "account_id",
                "account_type",
                F.coalesce("g_amount", F.lit(0.0)).alias("lifetime_donation_amount"),
                F.coalesce("g_n", F.lit(0)).alias("donation_count"),
                one(F.col("g_n") > 0).alias("is_donor"),
                one(F.col("g_amount") >= 300000).alias("is_major_donor"),
                one(F.col("user_type") == "COMPANY").alias("is_company"),
                F.col("email").isNotNull().cast("int").alias("has_email"),
                F.col("phone").isNotNull().cast("int").alias("has_phone"),
                F.coalesce("city", "state", "country").isNotNull().cast("int").alias("has_address"),
                F.coalesce("e_n", F.lit(0)).alias("events_attended"),
                one(F.col("e_n") > 0).alias("attends_events"),
                one(F.col("e_v") > 0).alias("is_volunteer"),
                F.coalesce("m_n", F.lit(0)).alias("membership_count"),
                F.coalesce("m_fees", F.lit(0.0)).alias("total_membership_fees"),
                one(F.col("m_n") > 0).alias("has_active_membership"),
                (F.datediff(today, "created").cast("double") / 365.25).alias("account_age_years"),
                one(F.datediff(today, "modified") <= 180).alias("has_recent_activity"),
            )
        )
