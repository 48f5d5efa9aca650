"""Queries on data quality, custom-field edits, migration and access tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import access as G
from almoner.operators import fields as E
from almoner.operators import migrate as M
from almoner.operators import quality as D
from almoner.operators.quality import FieldMeta
from almoner.plans.registry import query
from almoner.plans.search_queries import NAMES_SQL, _names

TAGS = ("Art", "Music", "Food")
KINDS = ("BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE")
FIELDS = [
    FieldMeta("v_email", "Email"),
    FieldMeta("v_web", "URL"),
    FieldMeta("v_phone", "Phone"),
    FieldMeta("v_amount", "Currency"),
    FieldMeta("v_pct", "Percentage"),
    FieldMeta("v_date", "Date"),
    FieldMeta("v_yes", "YesNo"),
    FieldMeta("v_tags", "MultiSelect", TAGS),
    FieldMeta("v_kind", "DropDown", KINDS),
    FieldMeta("v_owner", "Account"),
    FieldMeta("v_note", "OneLineText", required=True),
    FieldMeta("v_odd", "Signature"),
]

WIDE = """WITH wide AS (SELECT account_id, country, balance, email AS v_email,
  CASE WHEN balance < 3000 THEN 'https://' || replace(lower(state), '_', '') || '.example.org/a?b=1' WHEN balance < 6000 THEN 'ftp://x' END AS v_web,
  CASE WHEN balance < 200 THEN 'call me' ELSE phone END AS v_phone,
  CASE WHEN user_type = 'COMPANY' THEN '$' ELSE '' END || CAST(balance AS VARCHAR) || CASE WHEN balance > 9500 THEN ' or so' ELSE '' END AS v_amount,
  CAST(CAST(floor(balance / 80) AS BIGINT) AS VARCHAR) AS v_pct,
  CASE WHEN balance < 0 THEN '2023-02-31' WHEN balance < 2000 THEN '1850-01-01' ELSE strftime(created, '%Y-%m-%d') END AS v_date,
  CASE account_type WHEN 'BUILDING' THEN 'yes' WHEN 'MACHINERY' THEN 'True' WHEN 'FURNITURE' THEN 'maybe' WHEN 'HOUSEHOLD' THEN '' END AS v_yes,
  CASE WHEN balance < 0 THEN NULL WHEN balance < 2000 THEN 'Art' WHEN balance < 4000 THEN 'Art|Music' WHEN balance < 6000 THEN 'Art,Art' WHEN balance < 8000 THEN 'Art|Sport' ELSE '' END AS v_tags,
  account_type AS v_kind, CASE WHEN balance < 1000 THEN 'none' ELSE CAST(account_id AS VARCHAR) END AS v_owner,
  CASE WHEN balance > 500 THEN 'note ' || account_id || CASE WHEN balance < 900 THEN chr(7) ELSE '' END END AS v_note, city AS v_odd FROM accounts)
"""


def _wide(crm):
    b, kind = F.col("balance"), F.col("account_type")
    text = b.cast("string")
    host = F.concat(F.lit("https://"), F.replace(F.lower("state"), F.lit("_"), F.lit("")), F.lit(".example.org/a?b=1"))
    key = F.col("account_id").cast("string")
    return crm.accounts.select(
        "account_id",
        "country",
        "balance",
        F.col("email").alias("v_email"),
        F.when(b < 3000, host).when(b < 6000, "ftp://x").alias("v_web"),
        F.when(b < 200, "call me").otherwise(F.col("phone")).alias("v_phone"),
        F.concat(
            F.when(F.col("user_type") == "COMPANY", "$").otherwise(""), text, F.when(b > 9500, " or so").otherwise("")
        ).alias("v_amount"),
        F.floor(b / 80).cast("string").alias("v_pct"),
        F.when(b < 0, "2023-02-31").when(b < 2000, "1850-01-01").otherwise(F.date_format("created", "yyyy-MM-dd")).alias("v_date"),
        F.when(kind == "BUILDING", "yes").when(kind == "MACHINERY", "True").when(kind == "FURNITURE", "maybe").when(kind == "HOUSEHOLD", "").alias("v_yes"),
        F.when(b < 0, F.lit(None)).when(b < 2000, "Art").when(b < 4000, "Art|Music").when(b < 6000, "Art,Art").when(b < 8000, "Art|Sport").otherwise("").alias("v_tags"),
        kind.alias("v_kind"),
        F.when(b < 1000, "none").otherwise(key).alias("v_owner"),
        F.when(b > 500, F.concat(F.lit("note "), key, F.when(b < 900, "\a").otherwise(""))).alias("v_note"),
        F.col("city").alias("v_odd"),
    )


ISSUES = WIDE + """, issues AS (
  SELECT account_id, 'v_email' AS field, 'invalid_format' AS code, 'error' AS severity FROM wide WHERE v_email <> '' AND NOT regexp_full_match(trim(v_email), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')
  UNION ALL SELECT account_id, 'v_web', 'invalid_format', 'error' FROM wide WHERE starts_with(v_web, 'ftp')
  UNION ALL SELECT account_id, 'v_phone', 'invalid_format', 'error' FROM wide WHERE v_phone = 'call me'
  UNION ALL SELECT account_id, 'v_amount', 'invalid_format', 'error' FROM wide WHERE balance > 9500
  UNION ALL SELECT account_id, 'v_amount', 'negative_currency', 'warning' FROM wide WHERE balance < 0
  UNION ALL SELECT account_id, 'v_pct', 'range_warning', 'warning' FROM wide WHERE CAST(v_pct AS BIGINT) NOT BETWEEN 0 AND 100
  UNION ALL SELECT account_id, 'v_date', 'invalid_format', 'error' FROM wide WHERE balance < 0
  UNION ALL SELECT account_id, 'v_date', 'old_date', 'warning' FROM wide WHERE balance >= 0 AND balance < 2000
  UNION ALL SELECT account_id, 'v_yes', 'invalid_format', 'error' FROM wide WHERE v_yes = 'maybe'
  UNION ALL SELECT account_id, 'v_tags', 'invalid_options', 'error' FROM wide WHERE contains(v_tags, 'Sport')
  UNION ALL SELECT account_id, 'v_tags', 'duplicates', 'warning' FROM wide WHERE v_tags = 'Art,Art'
  UNION ALL SELECT account_id, 'v_kind', 'invalid_option', 'error' FROM wide WHERE v_kind = 'HOUSEHOLD'
  UNION ALL SELECT account_id, 'v_owner', 'invalid_format', 'error' FROM wide WHERE v_owner = 'none'
  UNION ALL SELECT account_id, 'v_note', 'required', 'error' FROM wide WHERE v_note IS NULL
  UNION ALL SELECT account_id, 'v_note', 'control_chars', 'warning' FROM wide WHERE contains(v_note, chr(7))
  UNION ALL SELECT account_id, 'v_odd', 'unknown_type', 'warning' FROM wide WHERE v_odd IS NOT NULL)
"""


@query(
    "D1_account_quality",
    """WITH q AS (SELECT count(*) AS total_checked, count(*) FILTER (WHERE coalesce(email, '') = '') AS missing_email, count(*) FILTER (WHERE coalesce(phone, '') = '') AS missing_phone,
      count(*) FILTER (WHERE trim(first_name) = '' OR trim(last_name) = '') AS incomplete_name, count(*) FILTER (WHERE email <> '' AND NOT contains(email, '@')) AS suspicious_email FROM accounts)
    SELECT *, CAST(missing_email AS DOUBLE) / total_checked * 100.0 AS missing_email_pct, CAST(missing_phone AS DOUBLE) / total_checked * 100.0 AS missing_phone_pct,
      CAST(incomplete_name AS DOUBLE) / total_checked * 100.0 AS incomplete_name_pct, CAST(suspicious_email AS DOUBLE) / total_checked * 100.0 AS suspicious_email_pct FROM q""",
)
def _(crm):
    return D.account_quality(crm.accounts)


@query(
    "D2_contact_selection",
    """SELECT count(*) AS accounts, count(email) AS with_email, count(phone) AS with_phone,
      count(*) FILTER (WHERE email IS NOT NULL AND phone IS NOT NULL AND last_name <> '') AS complete_profiles FROM accounts""",
)
def _(crm):
    return D.contact_selection(crm.accounts)


@query("D3_incomplete_profiles", "SELECT account_id FROM accounts WHERE email IS NULL OR phone IS NULL")
def _(crm):
    return D.incomplete_profiles(crm.accounts).select("account_id")


@query("D3_multiple_emails", "SELECT account_id FROM accounts WHERE email IS NOT NULL AND phone IS NOT NULL")
def _(crm):
    # the phone column stands in for a second address
    return D.multiple_emails(crm.accounts, "email", "phone").select("account_id")


@query(
    "D4_address_issues",
    """WITH a AS (SELECT account_id, CASE WHEN balance < 100 THEN '' WHEN balance < 300 THEN 'Castle' ELSE 'Home' END AS address_type,
      CASE WHEN balance < 9000 THEN 'Main 1' END AS street, city, CASE WHEN country = 'AMERICA' THEN 'US' WHEN country <> 'ASIA' THEN country END AS country,
      CASE WHEN balance < 7000 THEN state END AS state, CASE WHEN balance < 4000 THEN '12345' END AS zip FROM accounts)
    SELECT account_id, CASE WHEN address_type = '' THEN 'missing_addressType' WHEN street IS NULL THEN 'missing_streetAddress1' WHEN city IS NULL THEN 'missing_city' WHEN country IS NULL THEN 'missing_country'
      WHEN address_type = 'Castle' THEN 'invalid_addressType' WHEN country = 'US' AND state IS NULL THEN 'us_state_required' WHEN country = 'US' AND zip IS NULL THEN 'us_zip_required' END AS issue FROM a""",
)
def _(crm):
    b, country = F.col("balance"), F.col("country")
    rows = crm.accounts.select(
        "account_id",
        F.when(b < 100, "").when(b < 300, "Castle").otherwise("Home").alias("address_type"),
        F.when(b < 9000, "Main 1").alias("street"),
        "city",
        F.when(country == "AMERICA", "US").when(country != "ASIA", country).alias("country"),
        F.when(b < 7000, F.col("state")).alias("state"),
        F.when(b < 4000, "12345").alias("zip_code"),
    )
    return D.address_issues(rows).select("account_id", "issue")


@query("D5_validate_fields", ISSUES + "SELECT * FROM issues")
def _(crm):
    return D.validate_fields(_wide(crm).drop("country", "balance"), FIELDS, "account_id")


@query(
    "D5_validate_documents",
    """SELECT doc_id, 'text' AS field, 'max_length' AS code, 'error' AS severity FROM documents WHERE length(text) > 10000
      UNION ALL SELECT doc_id, 'text', 'control_chars', 'warning' FROM documents WHERE regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')
      UNION ALL SELECT doc_id, 'lang', 'invalid_option', 'error' FROM documents WHERE trim(lang) NOT IN ('en', 'de')""",
)
def _(crm):
    meta = [FieldMeta("text", "MultiLineText"), FieldMeta("lang", "Radio", ("en", "de"))]
    return D.validate_fields(crm.table("documents").select("doc_id", "text", "lang"), meta, "doc_id")


@query(
    "D6_required_and_unknown",
    ISSUES + "SELECT * FROM issues WHERE code IN ('required', 'unknown_type') UNION ALL SELECT account_id, 'country', 'field_not_found', 'error' FROM wide",
)
def _(crm):
    return D.required_and_unknown(_wide(crm).drop("balance"), FIELDS, "account_id")


@query(
    "D7_validation_summary",
    ISSUES
    + """, s AS (SELECT count(*) FILTER (WHERE severity = 'error') AS e, count(*) FILTER (WHERE severity = 'warning') AS w,
      count(DISTINCT (account_id, field)) FILTER (WHERE severity = 'error') AS bad, (SELECT count(*) FROM wide) * 12 AS total FROM issues)
    SELECT CAST(total AS BIGINT) AS total_fields, CAST(total - bad AS BIGINT) AS valid_fields, bad AS invalid_fields, e AS total_errors, w AS total_warnings, e = 0 AS overall_valid FROM s""",
)
def _(crm):
    return D.validation_summary(_wide(crm), FIELDS)


@query(
    "D8_pre_update_issues",
    """WITH u AS (SELECT event_id AS update_id, CASE event_type WHEN 'click' THEN 'V-1' WHEN 'view' THEN 'birth date' WHEN 'error' THEN 'Custom amount' WHEN 'signup' THEN 'C-opt' ELSE '77' END AS name,
      CASE WHEN value < 30 THEN '2020-01-05' WHEN value < 60 THEN CAST(value AS VARCHAR) WHEN value < 90 THEN 'yes' ELSE repeat('x', 1001) END AS v FROM events)
    SELECT update_id, 'unknown_name_pattern' AS code, 'warning' AS severity FROM u WHERE name = 'birth date'
    UNION ALL SELECT update_id, 'invalid_date', 'error' FROM u WHERE name = 'birth date' AND v <> '2020-01-05'
    UNION ALL SELECT update_id, 'invalid_number', 'error' FROM u WHERE name = 'Custom amount' AND TRY_CAST(v AS DOUBLE) IS NULL
    UNION ALL SELECT update_id, 'unclear_boolean', 'warning' FROM u WHERE name = 'C-opt' AND v <> 'yes'
    UNION ALL SELECT update_id, 'very_long_text', 'warning' FROM u WHERE length(v) > 1000""",
)
def _(crm):
    kind, value = F.col("event_type"), F.col("value")
    updates = crm.table("events").select(
        F.col("event_id").alias("update_id"),
        F.when(kind == "click", "V-1").when(kind == "view", "birth date").when(kind == "error", "Custom amount").when(kind == "signup", "C-opt").otherwise("77").alias("field_name"),
        F.lit(None).cast("string").alias("field_type"),
        F.when(value < 30, "2020-01-05").when(value < 60, value.cast("string")).when(value < 90, "yes").otherwise(F.repeat(F.lit("x"), 1001)).alias("value"),
    )
    return D.pre_update_issues(updates)


@query(
    "D9_profile_fields",
    WIDE
    + """, l AS (SELECT 'v_amount' AS field, v_amount AS v FROM wide UNION ALL SELECT 'v_date', v_date FROM wide UNION ALL SELECT 'v_yes', v_yes FROM wide UNION ALL SELECT 'v_note', v_note FROM wide),
    t AS (SELECT field, v, v IS NOT NULL AND v NOT IN ('', ' ') AS filled, CASE WHEN regexp_full_match(replace(replace(v, '.', ''), '-', ''), '\\d+') THEN 'numeric'
      WHEN length(v) = 10 AND contains(v, '-') THEN 'date' WHEN lower(v) IN ('true','false','yes','no') THEN 'boolean' ELSE 'text' END AS kind FROM l),
    k AS (SELECT field, kind, count(*) AS n FROM t WHERE filled GROUP BY field, kind),
    m AS (SELECT field, kind FROM k QUALIFY row_number() OVER (PARTITION BY field ORDER BY n DESC, CASE kind WHEN 'numeric' THEN 0 WHEN 'date' THEN 1 WHEN 'boolean' THEN 2 ELSE 3 END) = 1)
    SELECT t.field, count(*) AS checked, count(*) FILTER (WHERE filled) AS with_value, CAST(count(*) FILTER (WHERE filled) AS DOUBLE) / count(*) * 100.0 AS fill_rate, any_value(m.kind) AS inferred_type
      FROM t JOIN m ON m.field = t.field GROUP BY t.field""",
)
def _(crm):
    return D.profile_fields(_wide(crm), ["v_amount", "v_date", "v_yes", "v_note"])


@query(
    "D9_sample_values",
    WIDE
    + """, l AS (SELECT 'v_tags' AS field, v_tags AS value FROM wide UNION SELECT 'v_kind', v_kind FROM wide UNION SELECT 'v_pct', v_pct FROM wide)
    SELECT field, value, CAST(row_number() OVER (PARTITION BY field ORDER BY value) AS INTEGER) AS rank FROM l WHERE value IS NOT NULL AND value NOT IN ('', ' ') QUALIFY rank <= 3""",
)
def _(crm):
    return D.sample_values(_wide(crm), ["v_tags", "v_kind", "v_pct"])


@query(
    "D10_discover_fields",
    NAMES_SQL
    + """, d AS (SELECT name, list_filter([CASE WHEN regexp_full_match(name, '\\d+') THEN 'numeric_id' END, CASE WHEN regexp_full_match(name, '[A-Z]-\\d+') THEN 'prefixed_id' END,
      CASE WHEN regexp_full_match(name, '.+\\s-\\s.+') THEN 'dash_separated' END, CASE WHEN regexp_matches(name, '(?i)^(Custom|C-)') THEN 'custom_prefix' END, CASE WHEN length(name) > 50 THEN 'very_long' END,
      CASE WHEN regexp_matches(name, '(?i)(org|company)') THEN 'has_organization' END, CASE WHEN regexp_matches(name, '(?i)(date|time|when|created|modified)') THEN 'has_date' END,
      CASE WHEN regexp_matches(name, '(?i)(amount|cost|price|fee|total)') THEN 'has_amount' END], lambda x: x IS NOT NULL) AS c FROM names),
    e AS (SELECT unnest(CASE WHEN len(c) = 0 THEN ['none'] ELSE c END) AS pattern, CASE WHEN list_contains(c, 'numeric_id') THEN 'identifier' WHEN list_contains(c, 'has_date') THEN 'date'
      WHEN list_contains(c, 'has_amount') THEN 'number' WHEN list_contains(c, 'dash_separated') OR list_contains(c, 'custom_prefix') OR list_contains(c, 'very_long') THEN 'text' ELSE 'unknown' END AS likely_type FROM d)
    SELECT 'accounts' AS resource, pattern, likely_type, count(*) AS fields FROM e GROUP BY ALL""",
)
def _(crm):
    return D.discover_fields(_names(crm).select(F.lit("accounts").alias("resource"), F.col("name").alias("field")))


@query(
    "D11_bulk_validate",
    """SELECT account_id, 'v_tags' AS field, 'invalid_options' AS code, 'error' AS severity FROM accounts WHERE country = 'ASIA'
      UNION ALL SELECT account_id, 'v_pct', 'range_warning', 'warning' FROM accounts WHERE country = 'ASIA'""",
)
def _(crm):
    chosen = M.resource_filter(_wide(crm), {"country": "ASIA"})
    return D.bulk_validate(chosen, {"v_tags": "Art|Golf", "v_pct": "101", "v_yes": "no"}, FIELDS, "account_id")


def _updates(crm):
    country = F.col("country")
    value = F.when(country == "ASIA", "Music").when(country == "EUROPE", "Golf").when(country == "AFRICA", "BUILDING")
    field = F.when(country.isin("ASIA", "EUROPE"), "v_tags").when(country == "AFRICA", "v_kind")
    first = crm.accounts.select("account_id", field.alias("field"), value.alias("value"), F.lit(1).alias("seq"))
    again = crm.accounts.select(
        "account_id", F.lit("v_note").alias("field"), F.lit("rewritten").alias("value"), F.lit(2).alias("seq")
    ).where(F.col("balance") > 5000)
    return first.where(F.col("field").isNotNull()).unionByName(again)


@query(
    "M1_set_fields",
    WIDE
    + """SELECT account_id, CASE WHEN country = 'ASIA' THEN 'Music' ELSE v_tags END AS v_tags, CASE WHEN country = 'AFRICA' THEN 'BUILDING' ELSE v_kind END AS v_kind,
      CASE WHEN balance > 5000 THEN 'rewritten' ELSE v_note END AS v_note FROM wide""",
)
def _(crm):
    out = E.set_fields(_wide(crm), _updates(crm), FIELDS, "account_id")
    return out.select("account_id", "v_tags", "v_kind", "v_note")


@query(
    "M1_update_outcomes",
    """SELECT count(*) FILTER (WHERE country IN ('ASIA', 'AFRICA')) + count(*) FILTER (WHERE balance > 5000) AS successful, count(*) FILTER (WHERE country = 'EUROPE') AS failed FROM accounts""",
)
def _(crm):
    return E.update_outcomes(_updates(crm), FIELDS)


LISTS = WIDE + """, lists AS (SELECT account_id, list_filter(list_transform(string_split(coalesce(v_tags, ''), CASE WHEN contains(coalesce(v_tags, ''), '|') THEN '|' ELSE ',' END), lambda x: trim(x)), lambda x: x <> '') AS l, v_note FROM wide)
"""


def _tags(crm):
    from almoner.functions.scalars import parse_multivalue

    return _wide(crm).select("account_id", parse_multivalue(F.col("v_tags")).alias("l"), "v_note")


@query("M2_add_option", LISTS + "SELECT account_id, array_to_string(CASE WHEN list_contains(l, 'Music') THEN l ELSE list_append(l, 'Music') END, '|') AS tags FROM lists")
def _(crm):
    return _tags(crm).select("account_id", F.array_join(E.add_option(F.col("l"), "Music"), "|").alias("tags"))


@query(
    "M3_remove_option",
    LISTS + "SELECT account_id, array_to_string(CASE WHEN list_contains(l, 'Art') THEN list_concat(l[1:list_position(l, 'Art') - 1], l[list_position(l, 'Art') + 1:]) ELSE l END, '|') AS tags FROM lists",
)
def _(crm):
    return _tags(crm).select("account_id", F.array_join(E.remove_option(F.col("l"), "Art"), "|").alias("tags"))


@query("M4_append_text", LISTS + "SELECT account_id, CASE WHEN coalesce(v_note, '') = '' THEN 'more' ELSE v_note || '; ' || 'more' END AS note FROM lists")
def _(crm):
    return _tags(crm).select("account_id", E.append_text(F.col("v_note"), "more", "; ").alias("note"))


@query("M5_clear_field", "SELECT account_id, CAST(NULL AS VARCHAR) AS v_note FROM accounts")
def _(crm):
    return E.clear_field(_wide(crm), "v_note").select("account_id", "v_note")


def _batch(crm):
    kind, value = F.col("event_type"), F.col("value")
    return crm.table("events").select(
        F.col("user_id").alias("account_id"),
        F.when((kind == "signup") | (value > 200), "v_note").otherwise("v_tags").alias("field"),
        F.when(kind == "click", "add").when(kind == "view", "remove").when((kind == "error") & (value > 60), "replace")
        .when(kind == "error", "remove").when(kind == "purchase", "add").otherwise("append").alias("op"),
        F.when(kind == "click", "Music").when(kind == "view", "Art").when((kind == "error") & (value > 60), "Art|Food")
        .when(kind == "error", "Music").when((kind == "purchase") & (value > 30), "Golf").when(kind == "purchase", "Food").otherwise("+").alias("value"),
        F.col("event_id").alias("seq"),
    )


BATCH = WIDE + """, ops AS (SELECT user_id AS account_id, event_id AS seq, CASE WHEN event_type = 'signup' OR value > 200 THEN 'v_note' ELSE 'v_tags' END AS field,
  CASE event_type WHEN 'click' THEN 'add' WHEN 'view' THEN 'remove' WHEN 'error' THEN CASE WHEN value > 60 THEN 'replace' ELSE 'remove' END WHEN 'purchase' THEN 'add' ELSE 'append' END AS op,
  CASE event_type WHEN 'click' THEN 'Music' WHEN 'view' THEN 'Art' WHEN 'error' THEN CASE WHEN value > 60 THEN 'Art|Food' ELSE 'Music' END
    WHEN 'purchase' THEN CASE WHEN value > 30 THEN 'Golf' ELSE 'Food' END ELSE '+' END AS v FROM events),
judged AS (SELECT *, CASE WHEN field = 'v_tags' THEN v <> 'Golf' AND op <> 'append' ELSE op IN ('replace', 'append') END AS ok FROM ops),
live AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY seq) AS step FROM judged WHERE ok),
walk AS (
  SELECT account_id, 0::BIGINT AS step, list_filter(list_transform(string_split(coalesce(v_tags, ''), CASE WHEN contains(coalesce(v_tags, ''), '|') THEN '|' ELSE ',' END), lambda x: trim(x)), lambda x: x <> '') AS l,
    v_note AS note, false AS touched FROM wide
  UNION ALL
  SELECT w.account_id, o.step,
    CASE WHEN o.field <> 'v_tags' THEN w.l WHEN o.op = 'replace' THEN string_split(o.v, '|') WHEN o.op = 'add' THEN CASE WHEN list_contains(w.l, o.v) THEN w.l ELSE list_append(w.l, o.v) END
      WHEN list_contains(w.l, o.v) THEN list_concat(w.l[1:list_position(w.l, o.v) - 1], w.l[list_position(w.l, o.v) + 1:]) ELSE w.l END,
    CASE WHEN o.field <> 'v_note' THEN w.note WHEN o.op = 'replace' THEN o.v WHEN coalesce(w.note, '') = '' THEN o.v ELSE w.note || ' ' || o.v END,
    w.touched OR o.field = 'v_tags'
  FROM walk w JOIN live o ON o.account_id = w.account_id AND o.step = w.step + 1)
"""


@query(
    "M6_batch_update",
    BATCH
    + """SELECT w.account_id, CASE WHEN w.touched THEN array_to_string(w.l, '|') ELSE wide.v_tags END AS v_tags, w.note AS v_note
      FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY step DESC) = 1) w JOIN wide ON wide.account_id = w.account_id""",
)
def _(crm):
    return E.batch_update(_wide(crm), _batch(crm), FIELDS, "account_id").select("account_id", "v_tags", "v_note")


@query(
    "M6_batch_outcomes",
    BATCH + "SELECT op, count(*) AS total, count(*) FILTER (WHERE ok) AS successful, count(*) FILTER (WHERE NOT ok) AS failed FROM judged GROUP BY op",
)
def _(crm):
    return E.batch_outcomes(_batch(crm), FIELDS)


def _hot_batch(crm):
    hot = F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_suppkey"))
    which = F.pmod(F.col("l_quantity").cast("int"), F.lit(3))
    return crm.table("lineitem").select(
        hot.cast("bigint").alias("account_id"),
        F.lit("v_tags").alias("field"),
        F.when(F.col("l_returnflag") == "N", "add").otherwise("remove").alias("op"),
        F.when(which == 0, "Art").when(which == 1, "Music").otherwise("Food").alias("value"),
        (F.col("l_orderkey").cast("bigint") * 86400000000 + F.col("l_linenumber") * 1000 + F.col("l_suppkey") % 1000).alias("seq"),
    )


@query(
    "M6_hot_cell",
    WIDE
    + """, ops AS (SELECT CAST(CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_suppkey END AS BIGINT) AS account_id, CASE WHEN l_returnflag = 'N' THEN 'add' ELSE 'remove' END AS op,
      CASE CAST(l_quantity AS INTEGER) % 3 WHEN 0 THEN 'Art' WHEN 1 THEN 'Music' ELSE 'Food' END AS v, CAST(l_orderkey AS BIGINT) * 86400000000 + l_linenumber * 1000 + l_suppkey % 1000 AS seq FROM lineitem),
    sums AS (SELECT account_id, v, count(*) FILTER (WHERE op = 'remove') AS removals, max(seq) FILTER (WHERE op = 'remove') AS last FROM ops GROUP BY 1, 2),
    again AS (SELECT o.account_id, o.v, min(o.seq) AS at FROM ops o JOIN sums s ON s.account_id = o.account_id AND s.v = o.v
      WHERE o.op = 'add' AND (s.last IS NULL OR o.seq > s.last) GROUP BY 1, 2),
    lists AS (SELECT account_id, list_filter(list_transform(string_split(coalesce(v_tags, ''), CASE WHEN contains(coalesce(v_tags, ''), '|') THEN '|' ELSE ',' END), lambda x: trim(x)), lambda x: x <> '') AS l FROM wide),
    items AS (SELECT account_id, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM lists),
    nth AS (SELECT *, row_number() OVER (PARTITION BY account_id, v ORDER BY i) AS k FROM items),
    held AS (SELECT n.account_id, n.v, 0 AS part, n.i AS place FROM nth n LEFT JOIN sums s ON s.account_id = n.account_id AND s.v = n.v WHERE n.k > coalesce(s.removals, 0)
      UNION ALL SELECT a.account_id, a.v, 1, a.at FROM again a JOIN sums s ON s.account_id = a.account_id AND s.v = a.v
        WHERE s.removals >= (SELECT count(*) FROM items i WHERE i.account_id = a.account_id AND i.v = a.v)),
    joined AS (SELECT account_id, string_agg(v, '|' ORDER BY part, place) AS tags FROM held GROUP BY 1)
    SELECT w.account_id, CASE WHEN w.account_id IN (SELECT account_id FROM ops) THEN coalesce(j.tags, '') ELSE w.v_tags END AS v_tags
    FROM wide w LEFT JOIN joined j ON j.account_id = w.account_id""",
)
def _(crm):
    return E.batch_update(_wide(crm), _hot_batch(crm), FIELDS, "account_id").select("account_id", "v_tags")


PLAN = [
    M.FieldMapping("v_kind", "v_note", "MERGE"),
    M.FieldMapping("v_email", "v_odd", "COPY_IF_EMPTY"),
    M.FieldMapping("v_web", "v_phone", "REPLACE"),
    M.FieldMapping("v_yes", "v_tags", "ADD_OPTION", lambda c: F.lit("Food")),
    M.FieldMapping("v_pct", "v_owner", "TRANSFORM"),
]
MIGRATED = WIDE + """, ok AS (SELECT account_id, country, balance, v_note, v_odd, v_phone, v_tags,
  CASE WHEN v_note IS NULL OR v_note = '' THEN v_kind ELSE v_note || ' ' || v_kind END AS n_note,
  CASE WHEN v_email IS NOT NULL AND v_odd IS NULL THEN v_email ELSE v_odd END AS n_odd,
  CASE WHEN v_yes IS NULL OR contains(coalesce(v_tags, ''), 'Sport') THEN v_tags WHEN coalesce(v_tags, '') = '' THEN 'Food' WHEN v_tags = 'Art,Art' THEN 'Art|Art|Food' ELSE v_tags || '|Food' END AS n_tags,
  'success' AS s1, CASE WHEN v_email IS NULL THEN 'no_source' ELSE 'success' END AS s2, CASE WHEN v_web IS NULL THEN 'no_source' ELSE 'failed' END AS s3,
  CASE WHEN v_yes IS NULL THEN 'no_source' WHEN contains(coalesce(v_tags, ''), 'Sport') THEN 'failed' ELSE 'success' END AS s4, 'failed' AS s5 FROM wide)
"""


@query("M7_migrate", MIGRATED + "SELECT account_id, n_note AS v_note, n_odd AS v_odd, v_phone, n_tags AS v_tags, concat_ws(',', s1, s2, s3, s4, s5) AS status FROM ok")
def _(crm):
    done = M.migrate(_wide(crm), PLAN, FIELDS)
    status = F.array_join(F.transform(M.STATUS, lambda s: s["status"]), ",")
    return done.select("account_id", "v_note", "v_odd", "v_phone", "v_tags", status.alias("status"))


@query("M8_transform", WIDE + "SELECT account_id, upper(v_kind) || '!' AS v_note FROM wide")
def _(crm):
    plan = [M.FieldMapping("v_kind", "v_note", "REPLACE", lambda c: F.concat(F.upper(c), F.lit("!")))]
    return M.migrate(_wide(crm), plan, FIELDS).select("account_id", "v_note")


@query(
    "M9_migration_report",
    MIGRATED + "SELECT count(*) AS total, 0::BIGINT AS successful, count(*) AS failed, 0 AS skipped, count(*) FILTER (WHERE 'no_source' IN (s1, s2, s3, s4, s5)) AS no_source FROM ok",
)
def _(crm):
    return M.migration_report(M.migrate(_wide(crm), PLAN, FIELDS))


@query(
    "M9_mapping_report",
    MIGRATED
    + """SELECT mapping, status, count(*) AS count FROM (SELECT 'v_kind -> v_note' AS mapping, s1 AS status FROM ok UNION ALL SELECT 'v_email -> v_odd', s2 FROM ok UNION ALL SELECT 'v_web -> v_phone', s3 FROM ok
      UNION ALL SELECT 'v_yes -> v_tags', s4 FROM ok UNION ALL SELECT 'v_pct -> v_owner', s5 FROM ok) GROUP BY ALL""",
)
def _(crm):
    return M.mapping_report(M.migrate(_wide(crm), PLAN, FIELDS))


@query(
    "M10_dry_run",
    WIDE
    + """SELECT account_id, v_tags, CASE WHEN v_yes IS NULL THEN 'no_source' ELSE 'success' END AS status FROM wide""",
)
def _(crm):
    done = M.migrate(_wide(crm), [PLAN[3]], FIELDS, dry_run=True)
    return done.select("account_id", "v_tags", F.col(M.STATUS)[0]["status"].alias("status"))


@query(
    "M11_plan_from_mapping",
    WIDE
    + """SELECT account_id, CASE WHEN v_odd IS NULL AND v_kind IS NOT NULL THEN v_kind ELSE v_odd END AS v_odd,
      CASE WHEN v_email IS NULL THEN v_tags WHEN contains(coalesce(v_tags, ''), 'Sport') THEN v_tags WHEN coalesce(v_tags, '') = '' THEN 'Art' ELSE replace(v_tags, ',', '|') END AS v_tags FROM wide""",
)
def _(crm):
    config = {
        "v_email": {"field": "v_tags", "option": "Art"},
        "v_kind": {"field": "v_odd"},
        "v_web": "TODO",
    }
    return M.migrate(_wide(crm), M.plan_from_mapping(config), FIELDS).select("account_id", "v_odd", "v_tags")


@query(
    "M12_migration_conflicts",
    WIDE
    + """SELECT 'v_note -> v_tags' AS mapping, 'type_mismatch' AS kind, 'OneLineText -> MultiSelect' AS detail, NULL::BIGINT AS conflict_rows
      UNION ALL SELECT 'v_note -> v_tags', 'needs_text_parsing', 'v_note -> v_tags', NULL
      UNION ALL SELECT 'v_gone -> v_kind', 'missing_source', 'v_gone', NULL
      UNION ALL SELECT 'v_note -> v_tags', 'both_filled', NULL, count(*) FROM wide WHERE coalesce(v_note, '') <> '' AND coalesce(v_tags, '') <> ''""",
)
def _(crm):
    plan = [M.FieldMapping("v_note", "v_tags"), M.FieldMapping("v_gone", "v_kind", "COPY_IF_EMPTY")]
    return M.migration_conflicts(_wide(crm), plan, FIELDS)


@query(
    "M13_bulk_add_option",
    LISTS + "SELECT account_id, array_to_string(list_append(l, 'Music'), '|') AS v_tags FROM lists WHERE NOT list_contains(l, 'Music')",
)
def _(crm):
    return M.bulk_add_option(_wide(crm), "v_tags", "Music").select("account_id", "v_tags")


@query(
    "M14_all_pair_report",
    WIDE
    + """, p AS (SELECT v_kind, v_yes, v_tags, v_kind = '' OR v_kind IN ('yes','no','True','False') AS kind_yes, v_kind IS NULL AS nk, v_yes IS NULL AS ny, v_tags IS NULL AS nt FROM wide)
    SELECT 'v_kind' AS source, 'v_yes' AS target, count(*) FILTER (WHERE v_kind = '') AS success, count(*) FILTER (WHERE v_kind <> '') AS failed, count(*) FILTER (WHERE nk) AS skipped FROM p
    UNION ALL SELECT 'v_kind', 'v_tags', count(*) FILTER (WHERE v_kind = ''), count(*) FILTER (WHERE v_kind <> ''), count(*) FILTER (WHERE nk) FROM p
    UNION ALL SELECT 'v_yes', 'v_kind', count(*) FILTER (WHERE v_yes = ''), count(*) FILTER (WHERE v_yes <> ''), count(*) FILTER (WHERE ny) FROM p
    UNION ALL SELECT 'v_yes', 'v_tags', count(*) FILTER (WHERE v_yes = ''), count(*) FILTER (WHERE v_yes <> ''), count(*) FILTER (WHERE ny) FROM p
    UNION ALL SELECT 'v_tags', 'v_kind', count(*) FILTER (WHERE v_tags = ''), count(*) FILTER (WHERE v_tags <> ''), count(*) FILTER (WHERE nt) FROM p
    UNION ALL SELECT 'v_tags', 'v_yes', count(*) FILTER (WHERE v_tags = ''), count(*) FILTER (WHERE v_tags <> ''), count(*) FILTER (WHERE nt) FROM p""",
)
def _(crm):
    used = [m for m in FIELDS if m.name in ("v_kind", "v_yes", "v_tags")]
    return M.all_pair_report(_wide(crm), used)


# an empty text passes everywhere but in the required note, a filled one only there
PAIRED = ("v_kind", "v_yes", "v_tags", "v_note")
PAIRS = WIDE + ", u AS (" + " UNION ALL ".join(f"SELECT account_id, '{n}' AS source, {n} AS value FROM wide" for n in PAIRED) + """),
  pairs AS (SELECT s.account_id, s.source, t.source AS target, s.value AS source_value, CASE WHEN s.value IS NOT NULL THEN t.value END AS target_value,
    CASE WHEN s.value IS NULL THEN 'skipped' WHEN (s.value <> '') = (t.source = 'v_note') THEN 'success' ELSE 'failed' END AS status
    FROM u s JOIN u t ON t.account_id = s.account_id AND t.source <> s.source)
"""


def _paired():
    return [m for m in FIELDS if m.name in PAIRED]


@query(
    "M14_row_pair_report",
    PAIRS + "SELECT *, CASE status WHEN 'skipped' THEN 'No source value' WHEN 'failed' THEN 'Migration execution failed' END AS reason FROM pairs",
)
def _(crm):
    return M.row_pair_report(_wide(crm), _paired(), "account_id")


@query(
    "M14_row_pair_totals",
    PAIRS
    + """SELECT account_id, count(*) AS total_mappings, count(*) FILTER (WHERE status = 'success') AS successful_mappings, count(*) FILTER (WHERE status = 'failed') AS failed_mappings,
      count(*) FILTER (WHERE status = 'skipped') AS skipped_mappings FROM pairs GROUP BY account_id""",
)
def _(crm):
    return M.row_pair_totals(_wide(crm), _paired(), "account_id")


@query("M15_resource_filter", WIDE + "SELECT account_id FROM wide WHERE country = 'ASIA' AND v_kind = 'BUILDING'")
def _(crm):
    return M.resource_filter(_wide(crm), {"country": "ASIA", "v_kind": "BUILDING"}).select("account_id")


def _users(crm):
    kind = F.col("account_type")
    role = (
        F.when(F.col("balance") < 0, "volunteer_coordinator")
        .when(kind == "BUILDING", "viewer")
        .when(kind == "MACHINERY", "editor")
        .when(kind == "AUTOMOBILE", "admin")
        .when(kind == "FURNITURE", "fundraiser")
        .otherwise("event_manager")
    )
    return crm.accounts.select(F.col("account_id").alias("user_id"), role.alias("role"))


def _overrides(crm):
    own = crm.accounts.where(F.col("balance") > 9000).select(
        F.col("account_id").alias("user_id"), F.lit("donations").alias("resource"), F.lit("delete").alias("permission")
    )
    none = crm.accounts.where(F.col("balance") < 100).select(
        F.col("account_id").alias("user_id"), F.lit("accounts").alias("resource"), F.lit(None).cast("string").alias("permission")
    )
    return own.unionByName(none)


# Every role's cells, written out again on this side: role, permissions, resources.
MATRIX_SQL = """matrix(role, resource, permission) AS (
  SELECT role, unnest(string_split(resources, ' ')), permission
  FROM (SELECT role, resources, unnest(string_split(permissions, ' ')) AS permission FROM (VALUES
  ('viewer', 'read',
    'accounts activities addresses campaigns custom_fields custom_objects donations events grants ' ||
    'households memberships online_store orders payments pledges properties recurring_donations ' ||
    'soft_credits volunteers webhooks'),
  ('editor', 'read write update',
    'accounts activities addresses campaigns donations events grants households memberships online_store ' ||
    'pledges recurring_donations soft_credits volunteers'),
  ('editor', 'read',
    'custom_fields custom_objects properties webhooks'),
  ('editor', 'read update',
    'orders payments'),
  ('admin', 'admin',
    'accounts activities addresses campaigns custom_fields custom_objects donations events grants ' ||
    'households memberships online_store orders payments pledges properties recurring_donations ' ||
    'soft_credits volunteers webhooks'),
  ('fundraiser', 'read write update',
    'accounts activities addresses campaigns donations grants pledges recurring_donations soft_credits'),
  ('fundraiser', 'read',
    'custom_fields custom_objects events households memberships online_store orders payments properties ' ||
    'volunteers webhooks'),
  ('event_manager', 'read write update',
    'accounts activities addresses volunteers'),
  ('event_manager', 'read',
    'campaigns custom_fields custom_objects donations grants households memberships online_store orders ' ||
    'payments pledges properties recurring_donations soft_credits webhooks'),
  ('event_manager', 'read write update delete',
    'events'),
  ('volunteer_coordinator', 'read write update',
    'accounts activities addresses'),
  ('volunteer_coordinator', 'read',
    'campaigns custom_fields custom_objects donations events grants households memberships online_store ' ||
    'orders payments pledges properties recurring_donations soft_credits webhooks'),
  ('volunteer_coordinator', 'read write update delete',
    'volunteers')
  ) AS cells(role, permissions, resources)))"""


USERS = f"""WITH {MATRIX_SQL},
users AS (SELECT account_id AS user_id, CASE WHEN balance < 0 THEN 'volunteer_coordinator' ELSE CASE account_type WHEN 'BUILDING' THEN 'viewer' WHEN 'MACHINERY' THEN 'editor'
  WHEN 'AUTOMOBILE' THEN 'admin' WHEN 'FURNITURE' THEN 'fundraiser' ELSE 'event_manager' END END AS role FROM accounts),
over AS (SELECT account_id AS user_id, 'donations' AS resource, 'delete' AS permission FROM accounts WHERE balance > 9000 UNION ALL SELECT account_id, 'accounts', NULL FROM accounts WHERE balance < 100),
perms AS (SELECT u.user_id, m.resource, m.permission FROM users u JOIN matrix m ON m.role = u.role WHERE (u.user_id, m.resource) NOT IN (SELECT (user_id, resource) FROM over)
  UNION ALL SELECT user_id, resource, permission FROM over WHERE permission IS NOT NULL)
"""


@query("G1_role_matrix", USERS + "SELECT u.role, m.resource, m.permission, count(*) AS users FROM users u JOIN matrix m ON m.role = u.role GROUP BY ALL")
def _(crm):
    counts = _users(crm).groupBy("role").agg(F.count("*").alias("users"))
    return G.role_matrix(crm.spark).join(counts, "role")


@query("G2_effective_permissions", USERS + "SELECT user_id, resource, permission FROM perms")
def _(crm):
    return G.effective_permissions(_users(crm), G.role_matrix(crm.spark), _overrides(crm))


@query("G3_users_with", USERS + "SELECT DISTINCT user_id FROM perms WHERE resource = 'donations' AND permission IN ('delete', 'admin')")
def _(crm):
    perms = G.effective_permissions(_users(crm), G.role_matrix(crm.spark), _overrides(crm))
    return G.users_with(perms, "donations", "delete")


@query(
    "G3_override_roles",
    USERS
    + """SELECT u.user_id, m.permission FROM users u JOIN (SELECT * FROM matrix WHERE NOT (role = 'viewer' AND resource = 'events') UNION ALL SELECT 'viewer', 'events', 'write') m ON m.role = u.role AND m.resource = 'events'""",
)
def _(crm):
    change = crm.spark.createDataFrame([("viewer", "events", "write")], "role string, resource string, permission string")
    matrix = G.override_roles(G.role_matrix(crm.spark), change)
    return _users(crm).join(F.broadcast(matrix.where(F.col("resource") == "events")), "role").select("user_id", "permission")


@query(
    "G4_require",
    USERS
    + """, asked(resource, permission) AS (VALUES ('donations', 'read'), ('donations', 'delete'), ('accounts', 'update'), ('events', 'write'), ('webhooks', 'admin'))
    SELECT u.user_id, a.resource, a.permission, count(p.user_id) > 0 AS allowed FROM users u CROSS JOIN asked a
      LEFT JOIN perms p ON p.user_id = u.user_id AND p.resource = a.resource AND p.permission IN (a.permission, 'admin')
    GROUP BY u.user_id, a.resource, a.permission""",
)
def _(crm):
    asked = [("donations", "read"), ("donations", "delete"), ("accounts", "update"), ("events", "write"), ("webhooks", "admin")]
    perms = G.effective_permissions(_users(crm), G.role_matrix(crm.spark), _overrides(crm))
    return G.allowed(_users(crm), perms, asked)


@query("G5_row_rule", "SELECT donation_id FROM donations WHERE amount < 10000")
def _(crm):
    return G.row_rule(crm.donations, "viewer", {"viewer": "amount < 10000"}).select("donation_id")
