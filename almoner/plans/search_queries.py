"""Queries on sources, the search language, list filters, paging and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.functions import scalars as S
from almoner.functions.predicates import predicate
from almoner.operators import lists as L
from almoner.operators import paging as P
from almoner.operators import search as Q
from almoner.operators import sets as U
from almoner.plans.registry import query
from almoner.plans.standins import AS_OF
from almoner.session import scratch_folder
from almoner.sources import shaping, sinks
from almoner.sources.resources import get_by_key, primary_key, properties, read_resource


@query(
    "S1_read_resource",
    """SELECT account_type, count(*) AS n, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM accounts GROUP BY account_type""",
)
def _(crm):
    # written without types, and read back as the declared accounts resource
    folder = scratch_folder(crm.spark)
    raw = crm.accounts.select(
        F.col("account_id").cast("string").alias("accountId"),
        F.col("account_type").alias("userType"),
        F.col("first_name").alias("firstName"),
        F.col("balance").cast("string").alias("lastName"),
    )
    raw.write.json(f"{folder}/accounts")
    read = read_resource(crm.spark, f"{folder}/accounts", "accounts", "json")
    return read.groupBy(F.col("userType").alias("account_type")).agg(
        F.count(primary_key("accounts")).alias("n"),
        F.sum(F.col("lastName").cast("decimal(18,2)")).cast("double").alias("balance"),
    )


@query(
    "S2_unwrap_pages",
    """SELECT event_id AS id, event_type AS name, value FROM events""",
)
def _(crm):
    row = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    # one page per event, in each of the four accepted shapes
    pages = crm.table("events").select(
        F.when(F.col("event_type") == "click", F.to_json(F.struct(F.array(row).alias("events"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.array(row).alias("searchResults"))))
        .when(F.col("event_type") == "error", F.to_json(F.struct(F.array(row).alias("data"))))
        .otherwise(F.to_json(F.array(row)))
        .alias("body")
    )
    return shaping.unwrap_pages(pages, "events", "struct<id:bigint,name:string,value:double>")


@query(
    "S3_coerce",
    """SELECT account_id, TRY_CAST(CASE WHEN balance < 0 THEN 'n/a' ELSE CAST(balance AS VARCHAR) END AS DOUBLE) AS balance,
      CASE WHEN balance < 0 THEN NULL ELSE created END AS created FROM accounts""",
)
def _(crm):
    low = F.col("balance") < 0
    raw = crm.accounts.select(
        "account_id",
        F.when(low, "n/a").otherwise(F.col("balance").cast("string")).alias("balance"),
        F.when(low, "yesterday").otherwise(F.date_format("created", "yyyy-MM-dd HH:mm:ss")).alias("created"),
    )
    return shaping.coerce(raw, {"balance": "double", "created": "timestamp_ntz"})


@query(
    "S4_flatten_pair",
    """SELECT donation_id, coalesce(campaign_name, campaign_id) AS campaign FROM donations""",
)
def _(crm):
    nested = crm.donations.select(
        "donation_id", F.struct(F.col("campaign_id").alias("id"), F.col("campaign_name").alias("name")).alias("campaign")
    )
    return shaping.flatten_pair(nested, "campaign")


@query(
    "S5_contact_export",
    """SELECT account_id, trim(concat_ws(' ', first_name, last_name)) AS name, coalesce(email, '') AS email,
      coalesce(phone, '') AS phone, strftime(created, '%Y-%m-%d %H:%M:%S') AS created FROM accounts""",
)
def _(crm):
    return sinks.contact_export(crm.accounts)


@query(
    "S6_export_prospects",
    """SELECT account_id, account_type, city, state, email FROM accounts""",
)
def _(crm):
    folder = scratch_folder(crm.spark)
    sinks.export_prospects(crm.accounts, folder)
    schema = "account_id bigint, account_type string, city string, state string, email string"
    return read_resource(crm.spark, folder, fmt="csv", schema=schema, header="true")


VOLUNTEER_EXPORT = """WITH counted AS (
  SELECT *, CAST(len(list_filter(list_transform(string_split(coalesce(assigned_opportunities, ''), ','),
    lambda x: trim(x)), lambda x: x <> '')) AS INTEGER) AS opportunity_count,
    CASE WHEN assigned_opportunities IS NULL THEN 0 ELSE 1 END AS has_opportunities,
    CASE WHEN volunteer_group IS NULL THEN 0 ELSE 1 END AS has_group,
    CASE WHEN volunteer_role = '' THEN 0 ELSE 1 END AS has_role
  FROM volunteers),
exported AS (SELECT *, has_opportunities + has_group + has_role AS participation_score,
  CASE WHEN has_opportunities + has_group + has_role > 0 THEN 1 ELSE 0 END AS is_active_participant FROM counted)
"""


@query(
    "S7_volunteer_export",
    VOLUNTEER_EXPORT
    + """SELECT volunteer_id, account_id, opportunity_count, has_opportunities, has_group, has_role,
      participation_score, is_active_participant FROM exported""",
)
def _(crm):
    return sinks.volunteer_export(crm.volunteers).drop(
        "volunteer_group", "volunteer_role", "assigned_opportunities", "kind", "status"
    )


@query(
    "S8_apply_changes",
    """WITH changes AS (
      SELECT account_id, balance, email,
        CASE WHEN country = 'ASIA' THEN 'delete' WHEN country = 'EUROPE' THEN 'put'
          WHEN country = 'AFRICA' THEN 'patch' END AS op FROM accounts),
    kept AS (SELECT account_id, op, email, balance FROM changes WHERE op IS DISTINCT FROM 'delete')
    SELECT account_id, CASE op WHEN 'put' THEN balance * 2 ELSE balance END AS balance,
      CASE op WHEN 'put' THEN 'new@example.org' WHEN 'patch' THEN NULL ELSE email END AS email FROM kept
    UNION ALL SELECT -1 - account_id, 1.0, 'made@example.org' FROM accounts WHERE country = 'AMERICA'""",
)
def _(crm):
    base = crm.accounts.select("account_id", "balance", "email")
    seq = F.col("account_id")
    none = F.array().cast("array<string>")
    rows = crm.accounts.select(
        "account_id", "country", F.col("balance").alias("old"), F.lit(None).cast("string").alias("email")
    )
    def change(country, op, balance, email, names, key=F.col("account_id")):
        return rows.where(F.col("country") == country).select(
            key.alias("account_id"), balance.cast("double").alias("balance"), email.cast("string").alias("email"),
            seq.alias("seq"), F.lit(op).alias("op"), names.alias("set_columns"),
        )
    changes = U.union_all(
        [
            change("ASIA", "delete", F.lit(None), F.lit(None), none),
            change("EUROPE", "put", F.col("old") * 2, F.lit("new@example.org"), none),
            change("AFRICA", "patch", F.lit(7.0), F.lit(None), F.array(F.lit("email"))),
            change("AMERICA", "create", F.lit(1.0), F.lit("made@example.org"), none, -F.lit(1) - seq),
        ]
    )
    return sinks.apply_changes(base, changes, "account_id")


@query(
    "S9_link_edges",
    """SELECT DISTINCT o_custkey AS individual_id, l_suppkey AS company_id FROM orders JOIN lineitem
      ON o_orderkey = l_orderkey WHERE l_returnflag <> 'N' OR l_linestatus = 'F'""",
)
def _(crm):
    both = crm.table("orders").join(crm.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    edge = [F.col("o_custkey").alias("individual_id"), F.col("l_suppkey").alias("company_id")]
    edges = both.where("l_returnflag <> 'N'").select(*edge)
    return sinks.link_edges(edges, both.where("l_linestatus = 'F'").select(*edge))


@query(
    "S9_unlink_edges",
    """SELECT o_custkey AS individual_id, l_suppkey AS company_id FROM orders JOIN lineitem
      ON o_orderkey = l_orderkey EXCEPT SELECT o_custkey, l_suppkey FROM orders JOIN lineitem
      ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
)
def _(crm):
    both = crm.table("orders").join(crm.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    edge = [F.col("o_custkey").alias("individual_id"), F.col("l_suppkey").alias("company_id")]
    return sinks.unlink_edges(
        both.select(*edge).distinct(), both.where("l_returnflag = 'R'").select(*edge)
    )


def _predicate_query(name, column, operator, value, condition):
    @query(name, f"SELECT account_id FROM accounts WHERE {condition}")
    def _(crm):
        return crm.accounts.where(predicate(F.col(column), operator, value)).select("account_id")


_predicate_query("P1_op_equal", "account_type", "EQUAL", "BUILDING", "account_type = 'BUILDING'")
_predicate_query("P2_op_not_equal", "email", "NOT_EQUAL", "x", "email IS DISTINCT FROM 'x'")
_predicate_query("P3_op_blank", "last_name", "BLANK", None, "last_name IS NULL OR trim(last_name) = ''")
_predicate_query("P4_op_not_blank", "email", "NOT_BLANK", None, "email IS NOT NULL AND trim(email) <> ''")
_predicate_query("P5_op_lt", "balance", "LESS_THAN", 500, "balance < 500")
_predicate_query("P6_op_gt", "balance", "GREATER_THAN", "500.5", "balance > 500.5")
_predicate_query("P7_op_le", "created", "LESS_AND_EQUAL", AS_OF.replace(year=1998), "created <= TIMESTAMP '1998-08-02'")
_predicate_query("P8_op_ge", "balance", "GREATER_AND_EQUAL", 5000, "balance >= 5000")
_predicate_query("P9_op_in", "state", "IN_RANGE", ["NATION_1", "NATION_7"], "state IN ('NATION_1', 'NATION_7')")
_predicate_query("P10_op_not_in", "phone", "NOT_IN_RANGE", ["1"], "phone IS NULL OR phone NOT IN ('1')")
_predicate_query("P11_op_contain", "email", "CONTAIN", "7@EXAMPLE", "contains(lower(email), '7@example')")


@query(
    "P11_op_contain_literal",
    """SELECT doc_id, contains(text, '%') AS percent, contains(text, '_') AS line FROM documents
      WHERE contains(text, '%') OR contains(text, '_')""",
)
def _(crm):
    # signs that a pattern would take for wildcards, in whole texts
    marks = {"percent": predicate(F.col("text"), "CONTAIN", "%"), "line": predicate(F.col("text"), "CONTAIN", "_")}
    return crm.table("documents").withColumns(marks).where("percent or line").select("doc_id", *marks)


_predicate_query("P12_op_not_contain", "email", "NOT_CONTAIN", "@", "email IS NULL OR NOT contains(email, '@')")
_predicate_query("P13_op_between", "balance", "BETWEEN", "100|900", "balance BETWEEN 100 AND 900")
_predicate_query("P14_op_in_list", "state", "IN", "NATION_2, NATION_3", "state IN ('NATION_2', 'NATION_3')")


@query(
    "P15_project",
    """SELECT donation_id, CAST(amount AS DOUBLE) AS amount FROM donations
      WHERE amount >= 100000 AND status <> 'P' AND date < TIMESTAMP '2000-01-01'""",
)
def _(crm):
    request = {
        "searchFields": [
            {"field": "amount", "operator": "GREATER_AND_EQUAL", "value": 100000},
            {"field": "status", "operator": "NOT_EQUAL", "value": "P"},
            {"field": "date", "operator": "LESS_THAN", "value": "2000-01-01"},
        ],
        "outputFields": ["donation_id", "amount"],
    }
    return Q.search(crm.donations, request).withColumn("amount", F.col("amount").cast("double"))


@query(
    "P16_rename_request",
    """SELECT o_orderkey AS "ID", o_totalprice AS "Donation Amount" FROM orders WHERE o_totalprice > 250000""",
)
def _(crm):
    table = crm.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    request = {
        "searchFields": [{"field": "Donation Amount", "operator": "GREATER_THAN", "value": 250000}],
        "outputFields": ["Donation ID", "Amount"],
    }
    return Q.to_display(Q.search(table, Q.rename_request(request)))


CUSTOM_IDS = {"V-Segment": "101", "V-Balance": "102"}


def _custom(crm):
    return crm.accounts.select(
        "account_id", F.col("account_type").alias("101"), F.col("balance").alias("102")
    )


@query(
    "P17_resolve_custom_names",
    """SELECT account_id, balance AS "102" FROM accounts WHERE account_type = 'FURNITURE' AND balance > 100""",
)
def _(crm):
    request = {
        "searchFields": [
            {"field": "V-Segment", "operator": "EQUAL", "value": "FURNITURE"},
            {"field": "102", "operator": "GREATER_THAN", "value": 100},
        ],
        "outputFields": ["account_id", "V-Balance"],
    }
    table = _custom(crm)
    return Q.search(table, Q.resolve_custom_names(request, CUSTOM_IDS, table.columns))


@query(
    "P18_normalise_literals",
    """SELECT account_id, balance AS "102" FROM accounts WHERE account_id >= 40 AND balance < 9000""",
)
def _(crm):
    request = {
        "searchFields": [
            {"field": "account_id", "operator": "GREATER_AND_EQUAL", "value": 40},
            {"field": "102", "operator": "LESS_THAN", "value": 9000},
        ],
        "outputFields": ["account_id", "102"],
    }
    return Q.search(_custom(crm), Q.normalise_literals(request))


@query(
    "P19_search_by_custom_field",
    """SELECT account_id, account_type AS "101", balance AS "102" FROM accounts WHERE contains(lower(account_type), 'mach')""",
)
def _(crm):
    return Q.search_by_custom_field(_custom(crm), CUSTOM_IDS, "V-Segment", "mach", "CONTAIN")


CATALOG = [
    ("accounts", "firstName", "string", True, True),
    ("accounts", "balance", "number", True, True),
    ("accounts", "created", "date", True, True),
    ("accounts", "optIn", "boolean", True, False),
    ("accounts", "kind", "enum", True, True),
]


@query(
    "P20_validate_requests",
    """WITH f AS (SELECT c_custkey AS request_id, c_mktsegment AS seg, c_acctbal AS bal FROM customer)
    SELECT request_id, 'search' AS part, 0 AS position, 'field_unknown' AS code FROM f WHERE seg = 'BUILDING'
    UNION ALL SELECT request_id, 'search', 0, 'operator_not_allowed' FROM f WHERE seg = 'MACHINERY'
    UNION ALL SELECT request_id, 'search', 0, 'value_type' FROM f WHERE seg = 'MACHINERY'
    UNION ALL SELECT request_id, 'search', 0, 'range_needs_two' FROM f WHERE seg = 'AUTOMOBILE'
    UNION ALL SELECT request_id, 'search', 0, 'value_type' FROM f WHERE seg = 'FURNITURE' AND bal < 0
    UNION ALL SELECT request_id, 'search', 0, 'value_not_wanted' FROM f WHERE seg = 'HOUSEHOLD'
    UNION ALL SELECT request_id, 'search', 1, 'operator_unknown' FROM f
    UNION ALL SELECT request_id, 'output', 1, 'field_unknown' FROM f WHERE bal < 5000
    UNION ALL SELECT request_id, 'output', 0, 'output_missing' FROM f WHERE bal >= 5000 AND bal < 8000
    UNION ALL SELECT request_id, 'pagination', 0, 'page_size_range' FROM f WHERE bal > 500 OR bal < 1
    UNION ALL SELECT request_id, 'pagination', 0, 'page_negative' FROM f WHERE bal < 0""",
)
def _(crm):
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")

    def ask(field, operator, values, kind):
        return F.struct(
            F.lit(field).alias("field"),
            F.lit(operator).alias("operator"),
            (F.array(*[F.lit(v) if isinstance(v, str) else v for v in values]) if values else F.lit(None).cast("array<string>")).alias("values"),
            F.lit(kind).alias("value_type"),
        )

    date = F.when(bal < 0, "2001-13-40").otherwise("2001-02-31")
    first = (
        F.when(seg == "BUILDING", ask("shoeSize", "EQUAL", ["9"], "string"))
        .when(seg == "MACHINERY", ask("optIn", "LESS_THAN", ["1"], "number"))
        .when(seg == "AUTOMOBILE", ask("balance", "IN_RANGE", ["1", "2", "3"], "number"))
        .when(seg == "FURNITURE", ask("created", "GREATER_THAN", [date], "string"))
        .otherwise(ask("kind", "BLANK", ["x"], "string"))
    )
    requests = crm.table("customer").select(
        F.col("c_custkey").alias("request_id"),
        F.lit("accounts").alias("resource"),
        F.array(first, ask("firstName", "LIKE", ["a"], "string")).alias("search_fields"),
        F.when(bal < 5000, F.array(F.lit("firstName"), F.lit("optIn")))
        .when(bal < 8000, F.array().cast("array<string>"))
        .alias("output_fields"),
        F.floor(bal).cast("int").alias("current_page"),
        F.when(bal < 1, 0).when(bal > 500, 501).otherwise(50).alias("page_size"),
    )
    catalog = crm.spark.createDataFrame(
        CATALOG, "resource string, field string, field_type string, searchable boolean, outputable boolean"
    )
    return Q.validate_requests(requests, catalog)


@query(
    "P21_since",
    """SELECT count(*) FILTER (WHERE date >= TIMESTAMP '1999-08-02') AS two_years,
      count(*) FILTER (WHERE date >= TIMESTAMP '2001-08-02' - INTERVAL 90 DAY) AS ninety_days FROM donations""",
)
def _(crm):
    two = Q.since(crm.donations, "date", AS_OF, years=2).agg(F.count("*").alias("two_years"))
    ninety = Q.since(crm.donations, "date", AS_OF, days=90).agg(F.count("*").alias("ninety_days"))
    return two.select("two_years", ninety.scalar().alias("ninety_days"))


@query("L0_get_by_key", "SELECT account_id, email FROM accounts WHERE account_id = 42")
def _(crm):
    return get_by_key(crm.accounts, "account_id", 42).select("account_id", "email")


@query(
    "L1_list_accounts",
    "SELECT account_id, user_type FROM accounts WHERE user_type = 'COMPANY' ORDER BY account_id LIMIT 25",
)
def _(crm):
    return L.list_accounts(crm.accounts, "COMPANY", limit_rows=25).select("account_id", "user_type")


@query(
    "L2_list_events",
    """SELECT event_id FROM events WHERE event_type = 'click' AND value < 50
      AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""",
)
def _(crm):
    kind = F.when(F.col("value") < 50, "OPEN").otherwise("CLOSED")
    table = crm.table("events").select(
        "event_id", F.col("event_type").alias("category_id"), kind.alias("status"), F.col("ts").alias("start_date")
    )
    return L.list_events(table, "OPEN", "click", "2024-01-05", "2024-01-20").select("event_id")


@query("L3_list_campaigns", "SELECT campaign_id FROM campaigns WHERE status = 'ACTIVE' AND type = 'Appeal'")
def _(crm):
    return L.list_campaigns(crm.campaigns, "ACTIVE", "Appeal").select("campaign_id")


@query(
    "L4_list_memberships",
    """SELECT account_id, order_id FROM memberships WHERE status = 'F' AND type_id = 3
      AND term_start >= TIMESTAMP '1997-01-01' AND term_start <= TIMESTAMP '1999-01-01'""",
)
def _(crm):
    return L.list_memberships(crm.memberships, "F", 3, "1997-01-01", "1999-01-01").select("account_id", "order_id")


@query(
    "L5_list_recurring",
    "SELECT recurring_id FROM recurring WHERE status = 'Active' AND frequency = '2-HIGH' AND start_date >= TIMESTAMP '2000-01-01'",
)
def _(crm):
    return L.list_recurring(crm.recurring, "Active", "2-HIGH", start="2000-01-01").select("recurring_id")


@query(
    "L6_list_soft_credits",
    "SELECT donation_id FROM donations WHERE campaign_id = '3' AND date <= TIMESTAMP '1996-06-30'",
)
def _(crm):
    return L.list_soft_credits(crm.donations, campaign_id="3", end="1996-06-30").select("donation_id")


@query(
    "L7_list_grants",
    "SELECT donation_id FROM donations WHERE status = 'O' AND source = '5-LOW' AND date >= TIMESTAMP '2001-01-01'",
)
def _(crm):
    grants = crm.donations.select("donation_id", "status", F.col("source").alias("funder"), F.col("date").alias("start_date"))
    return L.list_grants(grants, "O", "5-LOW", "2001-01-01").select("donation_id")


@query("L8_list_households", "SELECT account_id FROM accounts WHERE state = 'NATION_4'")
def _(crm):
    return L.list_households(crm.accounts.withColumnRenamed("state", "name"), "NATION_4").select("account_id")


@query("L9_list_orders", "SELECT donation_id FROM donations WHERE status = 'F' AND date <= TIMESTAMP '1995-12-31'")
def _(crm):
    return L.list_orders(crm.donations, "F", end="1995-12-31").select("donation_id")


@query(
    "L10_list_payments",
    "SELECT donation_id FROM donations WHERE status = 'F' AND source = '1-URGENT' AND date >= TIMESTAMP '1999-01-01'",
)
def _(crm):
    payments = crm.donations.withColumnRenamed("source", "method")
    return L.list_payments(payments, "F", "1-URGENT", "1999-01-01").select("donation_id")


@query("L11_list_pledges", "SELECT donation_id FROM donations WHERE campaign_id = '2' AND fund = 'Fund O' AND status = 'O'")
def _(crm):
    return L.list_pledges(crm.donations.withColumnRenamed("fund", "fund_id"), "2", "Fund O", "O").select("donation_id")


@query(
    "L12_list_volunteers",
    "SELECT volunteer_id FROM volunteers WHERE status = 'ACTIVE' AND volunteer_role = 'view' AND kind = 'INDIVIDUAL'",
)
def _(crm):
    table = crm.volunteers.withColumnsRenamed({"volunteer_role": "skill_id", "kind": "availability"})
    return L.list_volunteers(table, "ACTIVE", "view", "INDIVIDUAL").select("volunteer_id")


@query("L13_list_products", "SELECT p_partkey FROM part WHERE p_brand = 'Brand#3' AND p_type = 'PROMO'")
def _(crm):
    table = crm.table("part").select("p_partkey", F.col("p_brand").alias("category_id"), F.col("p_type").alias("status"))
    return L.list_products(table, "PROMO", "Brand#3").select("p_partkey")


@query("L13_list_transactions", "SELECT donation_id FROM donations WHERE status = 'O' AND date >= TIMESTAMP '2001-07-01'")
def _(crm):
    return L.list_transactions(crm.donations, "O", "2001-07-01").select("donation_id")


@query("L13_list_store_orders", "SELECT donation_id FROM donations WHERE status = 'F' AND account_id = 7")
def _(crm):
    return L.list_store_orders(crm.donations.withColumnRenamed("account_id", "customer_id"), "F", 7).select("donation_id")


@query("L14_list_custom_objects", "SELECT account_id FROM accounts WHERE account_type = 'BUILDING' AND country = 'ASIA'")
def _(crm):
    table = crm.accounts.withColumnsRenamed({"account_type": "type", "country": "status"})
    return L.list_custom_objects(table, "BUILDING", "ASIA").select("account_id")


@query("L15_list_custom_fields", "SELECT id, name FROM custom_fields WHERE component = 'Brand#7'")
def _(crm):
    return L.list_custom_fields(crm.custom_fields, "Brand#7").select("id", "name")


@query("L15_find_field", "SELECT id, component FROM custom_fields WHERE name = 'hot gear'")
def _(crm):
    return L.find_field(crm.custom_fields, "hot gear").select("id", "component")


@query("L15_list_groups", "SELECT DISTINCT group_name, component FROM custom_fields WHERE component = 'Brand#11'")
def _(crm):
    return L.list_groups(crm.custom_fields, "Brand#11")


@query("L16_properties", "SELECT DISTINCT o_orderpriority AS id, substr(o_orderpriority, 3) AS name FROM orders")
def _(crm):
    folder = scratch_folder(crm.spark)
    found = U.distinct_keys(crm.table("orders"), "o_orderpriority")
    found = found.select(F.col("o_orderpriority").alias("id"), F.expr("substr(o_orderpriority, 3)").alias("name"))
    found.write.parquet(f"{folder}/sources.parquet")
    return properties(crm.spark, folder, "sources")


@query(
    "L17_list_registrations",
    """SELECT registration_id, status FROM registrations WHERE event_id = 'signup'
      ORDER BY status DESC, registration_id LIMIT 40""",
)
def _(crm):
    return L.list_registrations(crm.registrations, "signup", sort_column="status", direction="DESC", limit_rows=40).select(
        "registration_id", "status"
    )


@query(
    "L18_field_options",
    """SELECT name AS field, position, option_id, option FROM (
      SELECT name, unnest([0, 1]) AS position, unnest([id || 'a', id || 'b']) AS option_id,
        unnest([split_part(name, ' ', 1), split_part(name, ' ', 2)]) AS option FROM custom_fields)""",
)
def _(crm):
    part = lambda i: F.split_part("name", F.lit(" "), F.lit(i))
    option = lambda s, i: F.struct(F.concat("id", F.lit(s)).alias("id"), part(i).alias("name"))
    fields = crm.custom_fields.withColumn("option_values", F.array(option("a", 1), option("b", 2)))
    return L.field_options(fields)


@query("L18_membership_levels", "SELECT DISTINCT level FROM memberships WHERE level IS NOT NULL")
def _(crm):
    return L.membership_levels(crm.memberships)


@query("L19_nested_rows", "SELECT l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 100")
def _(crm):
    return L.nested_rows(crm.table("lineitem"), "l_orderkey", 100, ["l_linenumber", "l_partkey", "l_quantity"])


@query("T1_limit", "SELECT donation_id, account_id FROM donations ORDER BY donation_id LIMIT 100")
def _(crm):
    return P.limit(crm.donations.select("donation_id", "account_id"), 100, "donation_id")


@query(
    "T2_order_by_key",
    """WITH k AS (SELECT CASE WHEN value < 20 THEN CAST(event_id AS VARCHAR) ELSE upper(event_type) || event_id END AS k FROM events)
    SELECT k, row_number() OVER (ORDER BY CASE WHEN regexp_full_match(k, '[0-9]+') THEN 0 ELSE 1 END,
      TRY_CAST(k AS HUGEINT), lower(k), k) AS position FROM k""",
)
def _(crm):
    from almoner.operators.ranks import global_rank

    kind = F.concat(F.upper("event_type"), "event_id")
    keys = crm.table("events").select(
        F.when(F.col("value") < 20, F.col("event_id").cast("string")).otherwise(kind).alias("k")
    )
    # the place a row has in the ordered frame
    placed = P.order_by_key(keys, "k").withColumn("at", F.monotonically_increasing_id())
    return global_rank(placed, [F.asc("at")], "position").drop("at")


@query(
    "T3_page",
    """SELECT donation_id, account_id FROM donations ORDER BY donation_id LIMIT 200 OFFSET 1400""",
)
def _(crm):
    return P.page(crm.donations.select("donation_id", "account_id"), "donation_id", 7, 200)


@query(
    "T3_page_numbers",
    """SELECT account_id, CAST(floor((row_number() OVER (ORDER BY account_id) - 1) / 50) AS BIGINT) AS page FROM accounts""",
)
def _(crm):
    return P.page_numbers(crm.accounts.select("account_id"), "account_id", 50)


@query("T3_page_after", "SELECT donation_id FROM donations WHERE donation_id > 5000 ORDER BY donation_id LIMIT 500")
def _(crm):
    return P.page_after(crm.donations.select("donation_id"), "donation_id", 5000, 500)


@query(
    "T4_page_stats",
    "SELECT count(*) AS total_results, CAST(ceil(count(*) / 500.0) AS BIGINT) AS total_pages FROM donations",
)
def _(crm):
    return P.page_stats(crm.donations, 500)


@query(
    "T5_search_paginated",
    "SELECT donation_id FROM donations WHERE status = 'F' ORDER BY donation_id LIMIT 150",
)
def _(crm):
    request = {
        "searchFields": [{"field": "status", "operator": "EQUAL", "value": "F"}],
        "outputFields": ["donation_id"],
    }
    return P.search_paginated(crm.donations, request, "donation_id", page_size=50, max_pages=3)


@query("T6_sort", "SELECT account_id, balance FROM accounts ORDER BY balance DESC, account_id")
def _(crm):
    return P.sort(crm.accounts.select("account_id", "balance"), "balance", "DESC", ["account_id"])


@query("T7_top_n", "SELECT account_id, balance FROM accounts ORDER BY balance DESC, account_id LIMIT 20")
def _(crm):
    return P.top_n(crm.accounts.select("account_id", "balance"), "balance", 20, "account_id")


@query("T8_argmax", "SELECT donation_id, CAST(amount AS DOUBLE) AS amount FROM donations ORDER BY amount DESC, donation_id LIMIT 1")
def _(crm):
    table = crm.donations.select("donation_id", F.col("amount").cast("double").alias("amount"))
    return P.argmax(table, "amount", "donation_id")


@query(
    "T9_first_per_key",
    """SELECT account_id, donation_id, date FROM donations
      QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY date, donation_id) = 1""",
)
def _(crm):
    return P.first_per_key(crm.donations.select("account_id", "donation_id", "date"), "account_id", ["date", "donation_id"])


def _by_year(crm, year):
    return crm.donations.where(F.year("date") == year)


@query(
    "U1_keys_in_both",
    """SELECT account_id FROM donations WHERE year(date) = 2000 INTERSECT SELECT account_id FROM donations WHERE year(date) = 2001""",
)
def _(crm):
    return U.keys_in_both(_by_year(crm, 2000), _by_year(crm, 2001), "account_id")


@query(
    "U2_keys_only_in",
    """SELECT account_id FROM donations WHERE year(date) = 2001 EXCEPT SELECT account_id FROM donations WHERE year(date) = 2000""",
)
def _(crm):
    return U.keys_only_in(_by_year(crm, 2001), _by_year(crm, 2000), "account_id")


@query(
    "U3_union_all",
    "SELECT c_name AS name, c_acctbal AS balance, NULL AS s FROM customer UNION ALL SELECT s_name, s_acctbal, s_suppkey FROM supplier",
)
def _(crm):
    people = crm.table("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    firms = crm.table("supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("s")
    )
    return U.union_all([people, firms])


@query(
    "U4_dedupe_first",
    "SELECT name, id FROM custom_fields QUALIFY row_number() OVER (PARTITION BY name ORDER BY CAST(id AS BIGINT)) = 1",
)
def _(crm):
    fields = crm.custom_fields.select("name", "id", F.col("id").cast("bigint").alias("n"))
    return U.dedupe_first(fields, "name", ["n"]).drop("n")


@query("U5_distinct_keys", "SELECT DISTINCT account_id FROM donations WHERE account_id IS NOT NULL")
def _(crm):
    return U.distinct_keys(crm.donations, "account_id")


def _multi_text(crm):
    """Multi-value text per event in pipe and comma form, with blanks and surrounding spaces."""
    kind, value = F.col("event_type"), F.col("value")
    text = (
        F.when(value < 5, F.lit(""))
        .when(value < 20, F.concat(kind, F.lit(" | a, b||"), kind))
        .when(value < 60, F.concat(kind, F.lit(", x ,,"), kind))
        .when(value < 200, kind)
    )
    return crm.table("events").select("event_id", text.alias("t"), "value", "event_type", "props", "ts")


MULTI_SQL = """WITH m AS (SELECT event_id, value, event_type, ts, CASE WHEN value < 5 THEN '' WHEN value < 20 THEN event_type || ' | a, b||' || event_type
  WHEN value < 60 THEN event_type || ', x ,,' || event_type WHEN value < 200 THEN event_type END AS t FROM events),
p AS (SELECT *, list_filter(list_transform(string_split(coalesce(t, ''), CASE WHEN contains(coalesce(t, ''), '|') THEN '|' ELSE ',' END),
  lambda x: trim(x)), lambda x: x <> '') AS items FROM m)
"""


@query("F1_parse_multivalue", MULTI_SQL + "SELECT event_id, len(items) AS n, array_to_string(items, '/') AS items FROM p")
def _(crm):
    items = S.parse_multivalue(F.col("t"))
    return _multi_text(crm).select("event_id", F.size(items).cast("bigint").alias("n"), F.array_join(items, "/").alias("items"))


@query("F2_format_multivalue", MULTI_SQL + "SELECT event_id, array_to_string(items, ';') AS text FROM p")
def _(crm):
    items = S.parse_multivalue(F.col("t"))
    return _multi_text(crm).select("event_id", S.format_multivalue(items, ";").alias("text"))


@query(
    "F3_parse_bool",
    """WITH b AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'YES' WHEN 'view' THEN 'On' WHEN 'error' THEN 'no'
      WHEN 'signup' THEN '1' END AS t, value FROM events)
    SELECT event_id, coalesce(lower(t) IN ('true', 'yes', '1', 'on'), false) AS flag, floor(value) <> 0 AS from_number FROM b""",
)
def _(crm):
    kind = F.col("event_type")
    text = F.when(kind == "click", "YES").when(kind == "view", "On").when(kind == "error", "no").when(kind == "signup", "1")
    return crm.table("events").select(
        "event_id", S.parse_bool(text).alias("flag"), S.number_to_bool(F.floor("value")).alias("from_number")
    )


NUMBER_SQL = """WITH b AS (SELECT event_id, CASE event_type WHEN 'click' THEN CAST(value AS VARCHAR) WHEN 'view' THEN ''
  WHEN 'error' THEN 'n/a' WHEN 'signup' THEN '$1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '%' END AS t FROM events)
"""


def _number_text(crm):
    kind = F.col("event_type")
    money = F.concat(F.lit("$1,"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lit("%"))
    text = (
        F.when(kind == "click", F.col("value").cast("string"))
        .when(kind == "view", "")
        .when(kind == "error", "n/a")
        .when(kind == "signup", money)
    )
    return crm.table("events").select("event_id", text.alias("t"))


@query(
    "F4_parse_number",
    NUMBER_SQL
    + "SELECT event_id, coalesce(TRY_CAST(t AS DOUBLE), 0.0) AS number, CAST(trunc(coalesce(TRY_CAST(t AS DOUBLE), 0.0)) AS BIGINT) AS whole FROM b",
)
def _(crm):
    t = F.col("t")
    return _number_text(crm).select("event_id", S.parse_number(t).alias("number"), S.parse_number(t, True).alias("whole"))


@query(
    "F5_clean_number",
    NUMBER_SQL + "SELECT event_id, TRY_CAST(replace(replace(replace(t, ',', ''), '$', ''), '%', '') AS DOUBLE) AS number FROM b",
)
def _(crm):
    return _number_text(crm).select("event_id", S.clean_number(F.col("t")).alias("number"))


DATE_SQL = """WITH b AS (SELECT event_id, date_trunc('second', ts) AS ts, CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d')
  WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 'error' THEN strftime(ts, '%m/%d/%Y')
  WHEN 'signup' THEN strftime(ts, '%d/%m/%Y') ELSE '2023-02-31' END AS t, event_type FROM events)
"""


def _date_text(crm):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "error", F.date_format("ts", "MM/dd/yyyy"))
        .when(kind == "signup", F.date_format("ts", "dd/MM/yyyy"))
        .otherwise("2023-02-31")
    )
    return crm.table("events").select("event_id", text.alias("t"))


@query(
    "F6_parse_date",
    DATE_SQL
    + """SELECT event_id, coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%Y-%m-%dT%H:%M:%S'),
      try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%m/%d/%Y'), try_strptime(t, '%d/%m/%Y')) AS parsed FROM b""",
)
def _(crm):
    return _date_text(crm).select("event_id", S.parse_date(F.col("t")).alias("parsed"))


@query(
    "F7_loose_date_ok",
    DATE_SQL + "SELECT event_id, event_type NOT IN ('view', 'error', 'signup') AS ok FROM b",
)
def _(crm):
    return _date_text(crm).select("event_id", S.loose_date_ok(F.col("t")).alias("ok"))


@query(
    "F8_typed_value",
    NUMBER_SQL + "SELECT event_id, TRY_CAST(t AS DOUBLE) AS value, t AS raw FROM b",
)
def _(crm):
    typed = S.typed_value(F.col("t"), "Percentage")
    return _number_text(crm).select("event_id", typed["value"].alias("value"), typed["raw"].alias("raw"))


@query(
    "F9_format_value",
    """SELECT donation_id, CAST(amount AS VARCHAR) AS money, strftime(date, '%Y-%m-%d') AS day,
      strftime(date, '%Y-%m-%dT%H:%M:%S') AS moment, CASE WHEN status = 'F' THEN 'true' ELSE 'false' END AS flag FROM donations""",
)
def _(crm):
    return crm.donations.select(
        "donation_id",
        S.format_value(F.col("amount"), "Currency").alias("money"),
        S.format_value(F.col("date"), "Date").alias("day"),
        S.format_value(F.col("date"), "DateTime").alias("moment"),
        S.format_value(F.col("status") == "F", "YesNo").alias("flag"),
    )


@query(
    "F10_contact_patterns",
    """SELECT account_id, regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}') AS email_ok,
      regexp_full_match(phone, '\\+?[1-9]\\d{1,14}') OR regexp_full_match(phone, '[0-9\\-\\.\\s\\(\\)\\+]+') AS phone_ok FROM accounts""",
)
def _(crm):
    return crm.accounts.select("account_id", S.email_ok(F.col("email")).alias("email_ok"), S.phone_ok(F.col("phone")).alias("phone_ok"))


@query(
    "F10_url_ok",
    """SELECT page_id, regexp_matches(url, '(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\\.)+[A-Z]{2,6}\\.?|localhost|\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3})(?::\\d+)?(?:/?|[/?]\\S+)$') AS ok FROM pages""",
)
def _(crm):
    return crm.table("pages").select("page_id", S.url_ok(F.col("url")).alias("ok"))


@query(
    "F11_has_control_chars",
    "SELECT doc_id, regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') AS has_control FROM documents",
)
def _(crm):
    return crm.table("documents").select("doc_id", S.has_control_chars(F.col("text")).alias("has_control"))


@query(
    "F12_split_words",
    """SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[_\\-\\s]+'), lambda w: w <> '')) AS words FROM documents""",
)
def _(crm):
    from almoner.functions.text import split_words

    return crm.table("documents").select("doc_id", F.size(split_words(F.col("text"))).cast("bigint").alias("words"))


@query(
    "F13_meaningful_words",
    """SELECT item_id, array_to_string(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(text, '([a-z])([A-Z])', '\\1 \\2', 'g'),
      '[_\\-\\.]+', ' ', 'g')), '\\s+'), lambda w: length(w) > 2 AND w NOT IN ('a','an','the','of','for','in','on','at','to','is','are','and','or')), ' ') AS words FROM benchmark""",
)
def _(crm):
    from almoner.functions.text import meaningful_words

    return crm.table("benchmark").select("item_id", F.array_join(meaningful_words(F.col("text")), " ").alias("words"))


@query(
    "F14_privacy_band",
    """SELECT account_id, CASE WHEN balance < 100 THEN 'Small' WHEN balance < 1000 THEN 'Medium' WHEN balance < 10000 THEN 'Large'
      ELSE 'Major' END AS band FROM accounts""",
)
def _(crm):
    return crm.accounts.select("account_id", S.privacy_band(F.col("balance")).alias("band"))


@query(
    "F15_scale_to_100",
    "SELECT account_id, balance * 100.0 / max(balance) OVER () AS scaled FROM accounts",
)
def _(crm):
    from almoner.operators.scaling import scale_to_100

    return scale_to_100(crm.accounts.select("account_id", "balance"), "balance", "scaled").drop("balance")


@query(
    "F16_days_since",
    """SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-01-20 12:30:00') - epoch_us(ts)) / 86400000000.0) AS BIGINT) AS days FROM events""",
)
def _(crm):
    from datetime import datetime

    return crm.table("events").select("event_id", S.days_since(F.col("ts"), datetime(2024, 1, 20, 12, 30)).alias("days"))


@query("F17_month_key", "SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM donations GROUP BY 1")
def _(crm):
    return crm.donations.groupBy(S.month_key(F.col("date")).alias("month")).agg(F.count("*").alias("n"))


@query(
    "F18_type_flags",
    """SELECT account_id, CASE WHEN user_type = 'INDIVIDUAL' THEN 1 ELSE 0 END AS is_individual,
      CASE WHEN user_type = 'COMPANY' THEN 1 ELSE 0 END AS is_company, 0 AS is_household FROM accounts""",
)
def _(crm):
    flags = S.type_flags(F.col("user_type"))
    return crm.accounts.select("account_id", *[c.alias(n) for n, c in flags.items()])


NAMES_SQL = """WITH names AS (SELECT event_id, CASE WHEN value < 10 THEN CAST(event_id AS VARCHAR)
  WHEN value < 20 THEN 'V-' || event_id WHEN value < 40 THEN event_type || ' - ' || event_id
  WHEN value < 60 THEN 'custom ' || event_type WHEN value < 90 THEN event_type || ' date total'
  WHEN value < 120 THEN 'organization fee' WHEN value < 150 THEN repeat(event_type || '_', 12) ELSE event_type END AS name FROM events)
"""


def _names(crm):
    kind, value, key = F.col("event_type"), F.col("value"), F.col("event_id")
    name = (
        F.when(value < 10, key.cast("string"))
        .when(value < 20, F.concat(F.lit("V-"), key))
        .when(value < 40, F.concat(kind, F.lit(" - "), key))
        .when(value < 60, F.concat(F.lit("custom "), kind))
        .when(value < 90, F.concat(kind, F.lit(" date total")))
        .when(value < 120, "organization fee")
        .when(value < 150, F.repeat(F.concat(kind, F.lit("_")), 12))
        .otherwise(kind)
    )
    return crm.table("events").select("event_id", name.alias("name"))


@query(
    "F19_field_name_category",
    NAMES_SQL
    + """, h AS (SELECT event_id, regexp_full_match(name, '\\d+') AS a, regexp_full_match(name, '[A-Z]-\\d+') AS b,
      regexp_full_match(name, '.+\\s-\\s.+') AS c, regexp_matches(name, '(?i)^(Custom|C-)') AS d, length(name) > 50 AS e,
      regexp_matches(name, '(?i)(org|organization|company)') AS f, regexp_matches(name, '(?i)(date|time|when|created|modified)') AS g,
      regexp_matches(name, '(?i)(amount|cost|price|fee|total)') AS i FROM names)
    SELECT event_id, array_to_string(list_filter([CASE WHEN a THEN 'numeric_id' END, CASE WHEN b THEN 'prefixed_id' END,
      CASE WHEN c THEN 'dash_separated' END, CASE WHEN d THEN 'custom_prefix' END, CASE WHEN e THEN 'very_long' END,
      CASE WHEN f THEN 'has_organization' END, CASE WHEN g THEN 'has_date' END, CASE WHEN i THEN 'has_amount' END], lambda x: x IS NOT NULL), '|') AS categories,
      CASE WHEN a THEN 'identifier' WHEN g THEN 'date' WHEN i THEN 'number' WHEN c OR d OR e THEN 'text' ELSE 'unknown' END AS likely_type,
      CASE WHEN a THEN 0.9::DOUBLE WHEN g OR i THEN 0.8 WHEN c OR d THEN 0.7 WHEN e THEN 0.6 ELSE 0.0 END AS confidence FROM h""",
)
def _(crm):
    c = S.field_name_category(F.col("name"))
    return _names(crm).select("event_id", c.alias("c")).select(
        "event_id",
        F.array_join("c.categories", "|").alias("categories"),
        F.col("c.likely_type").alias("likely_type"),
        F.col("c.confidence").alias("confidence"),
    )


@query(
    "F20_looks_custom",
    NAMES_SQL
    + """SELECT event_id, starts_with(name, 'V-') OR starts_with(name, 'C-') OR starts_with(name, 'Custom') OR contains(name, ' - ') OR length(name) > 50 AS custom FROM names""",
)
def _(crm):
    return _names(crm).select("event_id", S.looks_custom(F.col("name")).alias("custom"))


@query(
    "F21_guess_value_type",
    DATE_SQL
    + """, v AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'Yes' WHEN event_type = 'view' THEN 'a-b-c-d-ef' ELSE t END AS t FROM b)
    SELECT event_id, CASE WHEN regexp_full_match(replace(replace(t, '.', ''), '-', ''), '\\d+') THEN 'numeric'
      WHEN length(t) = 10 AND contains(t, '-') THEN 'date' WHEN lower(t) IN ('true','false','yes','no') THEN 'boolean' ELSE 'text' END AS kind FROM v""",
)
def _(crm):
    kind = F.col("event_type")
    base = _date_text(crm).join(crm.table("events").select("event_id", "event_type"), "event_id")
    t = F.when(kind == "purchase", "Yes").when(kind == "view", "a-b-c-d-ef").otherwise(F.col("t"))
    return base.select("event_id", S.guess_value_type(t).alias("kind"))
