"""Data-quality reports and custom-field validation over whole tables.

Every rule of a row is checked in one projection; only the issues found become rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions import scalars as S
from almoner.functions.predicates import op_blank, op_not_blank
from almoner.operators.aggregates import rows, safe_ratio

# Words accepted in a yes/no field.
BOOLEAN_WORDS = ("true", "false", "True", "False", "yes", "no", "Yes", "No", "1", "0")
MAX_TEXT = 10000
MAX_EMAIL = 254
MAX_URL = 2000
# Address types and spellings of the United States.
ADDRESS_TYPES = ("Home", "Work", "Business", "Mailing", "Billing", "Shipping", "Vacation")
US_NAMES = ("USA", "United States", "US")


@dataclass(frozen=True)
class FieldMeta:
    """What is known about one custom field."""

    name: str
    display_type: str = "OneLineText"
    options: tuple[str, ...] = ()
    required: bool = False
    data_type: str | None = None
    id: str | None = None
    max_length: int = MAX_TEXT
    extra: Mapping[str, Any] = field(default_factory=dict, compare=False)


def field_meta(custom_fields: DataFrame) -> list[FieldMeta]:
    """Metadata rows as objects. There is one row per column, so this is read like a schema."""
    return [
        FieldMeta(
            name=r["name"],
            display_type=r["display_type"] or "",
            options=tuple(o["name"] for o in (r["option_values"] or [])),
            required=bool(r["required"]),
            data_type=r["data_type"],
            id=r["id"],
        )
        for r in custom_fields.select(
            "id", "name", "display_type", "data_type", "required", "option_values"
        ).collect()
    ]


Rule = tuple[Column, str, str]


def _text_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [
        (F.length(c) > meta.max_length, "max_length", "error"),
        (S.has_control_chars(c), "control_chars", "warning"),
    ]


def _email_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [
        (~S.email_ok(c), "invalid_format", "error"),
        (F.length(F.trim(c)) > MAX_EMAIL, "too_long", "error"),
    ]


def _url_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [
        (~S.url_ok(c), "invalid_format", "error"),
        (F.length(F.trim(c)) > MAX_URL, "very_long", "warning"),
    ]


def _phone_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [(~S.phone_ok(c), "invalid_format", "error")]


def _number_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    value = S.clean_number(c)
    out: list[Rule] = [(value.isNull(), "invalid_format", "error")]
    if meta.display_type == "Percentage":
        out.append(((value < 0) | (value > 100), "range_warning", "warning"))
    if meta.display_type == "Currency":
        out.append((value < 0, "negative_currency", "warning"))
    return out


def _date_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    value = S.parse_date(c)
    out: list[Rule] = [(value.isNull(), "invalid_format", "error")]
    if meta.display_type == "Date":
        out.append((F.year(value) < 1900, "old_date", "warning"))
    return out


def _boolean_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [(~c.isin(*BOOLEAN_WORDS), "invalid_format", "error")]


def _many_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    values = S.parse_multivalue(c)
    out: list[Rule] = []
    if meta.options:
        known = F.array(*[F.lit(o) for o in meta.options])
        out.append((F.size(F.array_except(values, known)) > 0, "invalid_options", "error"))
    out.append((F.size(F.array_distinct(values)) < F.size(values), "duplicates", "warning"))
    return out


def _one_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    if not meta.options:
        return []
    return [(~F.trim(c).isin(*meta.options), "invalid_option", "error")]


def _account_rules(c: Column, meta: FieldMeta) -> list[Rule]:
    return [(~F.trim(c).rlike(r"^[+-]?\d+$"), "invalid_format", "error")]


_RULES = {
    **dict.fromkeys(("OneLineText", "MultiLineText", "Text"), _text_rules),
    "Email": _email_rules,
    "URL": _url_rules,
    "Phone": _phone_rules,
    **dict.fromkeys(("Number", "Currency", "Percentage"), _number_rules),
    **dict.fromkeys(("Date", "DateTime", "Time"), _date_rules),
    "YesNo": _boolean_rules,
    **dict.fromkeys(("Checkbox", "MultiSelect"), _many_rules),
    **dict.fromkeys(("DropDown", "Dropdown", "RadioButton", "Radio"), _one_rules),
    **dict.fromkeys(("File", "Image"), lambda c, meta: []),
    "Account": _account_rules,
}


def field_issues(c: Column, meta: FieldMeta) -> Column:
    """Array of (field, code, severity) for one value; empty values only fail when required."""
    filled = c.isNotNull() & (c != "")
    rules: list[Rule] = []
    if meta.required:
        rules.append((~filled, "required", "error"))
    if meta.display_type in _RULES:
        checks = _RULES[meta.display_type](c, meta)
    else:
        checks = [(F.lit(True), "unknown_type", "warning")]
    rules += [(filled & test, code, severity) for test, code, severity in checks]
    found = [
        F.when(
            F.coalesce(test, F.lit(False)),
            F.struct(
                F.lit(meta.name).alias("field"),
                F.lit(code).alias("code"),
                F.lit(severity).alias("severity"),
            ),
        )
        for test, code, severity in rules
    ]
    if not found:
        return F.array().cast("array<struct<field:string,code:string,severity:string>>")
    return F.array_compact(F.array(*found))


def error_free(c: Column, meta: FieldMeta | None) -> Column:
    if meta is None:
        return F.lit(True)
    return ~F.exists(field_issues(c, meta), lambda i: i["severity"] == "error")


def validate_fields(df: DataFrame, fields: Sequence[FieldMeta], key: str) -> DataFrame:
    """One row per issue: key, field, code, severity. Columns without metadata are errors."""
    known = {m.name: m for m in fields}
    parts = [field_issues(F.col(f"`{n}`").cast("string"), m) for n, m in known.items() if n in df.columns]
    unknown = [c for c in df.columns if c != key and c not in known]
    parts += [
        F.array(
            F.struct(
                F.lit(c).alias("field"),
                F.lit("field_not_found").alias("code"),
                F.lit("error").alias("severity"),
            )
        )
        for c in unknown
    ]
    return df.select(key, F.inline(F.concat(*parts)))


def required_and_unknown(df: DataFrame, fields: Sequence[FieldMeta], key: str) -> DataFrame:
    """Only the missing-value, unknown-type and unknown-field issues."""
    wanted = ("required", "unknown_type", "field_not_found")
    return validate_fields(df, fields, key).where(F.col("code").isin(*wanted))


def validation_summary(df: DataFrame, fields: Sequence[FieldMeta]) -> DataFrame:
    """Checked fields, valid and invalid ones, errors, warnings, and whether all is valid."""
    used = [m for m in fields if m.name in df.columns]
    issues = [field_issues(F.col(f"`{m.name}`").cast("string"), m) for m in used]

    def counted(severity: str) -> list[Column]:
        return [F.size(F.filter(i, lambda x: x["severity"] == severity)) for i in issues]

    per_row = df.select(
        F.array(*counted("error")).alias("errors"), F.array(*counted("warning")).alias("warnings")
    ).select(
        F.size(F.filter("errors", lambda n: n > 0)).alias("bad"),
        F.aggregate("errors", F.lit(0), lambda a, n: a + n).alias("errors"),
        F.aggregate("warnings", F.lit(0), lambda a, n: a + n).alias("warnings"),
    )
    total = rows() * len(used)
    return per_row.agg(
        total.alias("total_fields"),
        (total - F.sum("bad")).alias("valid_fields"),
        F.sum("bad").alias("invalid_fields"),
        F.sum("errors").alias("total_errors"),
        F.sum("warnings").alias("total_warnings"),
        (F.sum("errors") == 0).alias("overall_valid"),
    )


def account_quality(accounts: DataFrame) -> DataFrame:
    """Missing email and phone, incomplete names and emails without @, with percentages."""
    email, phone = F.col("email"), F.col("phone")
    missing = lambda c: F.coalesce(c == "", F.lit(True))
    tests = {
        "missing_email": missing(email),
        "missing_phone": missing(phone),
        "incomplete_name": op_blank(F.col("first_name")) | op_blank(F.col("last_name")),
        "suspicious_email": ~missing(email) & ~F.contains(email, F.lit("@")),
    }
    counts = [F.count_if(t).alias(n) for n, t in tests.items()]
    shares = [safe_ratio(F.count_if(t), rows(), 100.0).alias(f"{n}_pct") for n, t in tests.items()]
    return accounts.agg(rows().alias("total_checked"), *counts, *shares)


def contact_selection(accounts: DataFrame) -> DataFrame:
    email, phone = op_not_blank(F.col("email")), op_not_blank(F.col("phone"))
    named = op_not_blank(F.col("first_name")) & op_not_blank(F.col("last_name"))
    return accounts.agg(
        rows().alias("accounts"),
        F.count_if(email).alias("with_email"),
        F.count_if(phone).alias("with_phone"),
        F.count_if(email & phone & named).alias("complete_profiles"),
    )


def incomplete_profiles(accounts: DataFrame) -> DataFrame:
    """Accounts without an email or a phone."""
    return accounts.where(op_blank(F.col("email")) | op_blank(F.col("phone")))


def multiple_emails(accounts: DataFrame, first: str = "email", second: str = "email2") -> DataFrame:
    return accounts.where(op_not_blank(F.col(first)) & op_not_blank(F.col(second)))


def address_issue() -> Column:
    """First failing reason of an address row, null when it is valid."""
    us = F.col("country").isin(*US_NAMES)
    blank = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    return (
        F.when(blank("address_type"), "missing_addressType")
        .when(blank("street"), "missing_streetAddress1")
        .when(blank("city"), "missing_city")
        .when(blank("country"), "missing_country")
        .when(~F.col("address_type").isin(*ADDRESS_TYPES), "invalid_addressType")
        .when(us & blank("state"), "us_state_required")
        .when(us & blank("zip_code"), "us_zip_required")
    )


def address_issues(addresses: DataFrame) -> DataFrame:
    return addresses.withColumn("issue", address_issue())


def pre_update_issues(updates: DataFrame, key: str = "update_id") -> DataFrame:
    """Issues of planned updates (field_name, field_type, value), judged by name hints."""
    name, kind, value = F.col("field_name"), F.coalesce("field_type", F.lit("")), F.col("value")
    low = F.lower(name)
    has = lambda *words: reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in words])
    patterns = [
        name.rlike(S.NAME_PATTERNS[p])
        for p in ("numeric_id", "prefixed_id", "dash_separated", "custom_prefix")
    ]
    is_date = (kind == "date") | has("date")
    is_number = ~is_date & ((kind == "number") | has("count", "amount", "score", "rating"))
    is_bool = ~is_date & ~is_number & ((kind == "boolean") | has("is_", "active", "enabled", "opt"))
    iso = value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & S.parse_date(value).isNotNull()
    tests = [
        (~reduce(Column.__or__, patterns), "unknown_name_pattern", "warning"),
        (is_date & ~F.coalesce(iso, F.lit(False)), "invalid_date", "error"),
        (is_number & S.read_number(value).isNull(), "invalid_number", "error"),
        (
            is_bool & ~F.coalesce(value.isin("true", "false", "yes", "no", "1", "0"), F.lit(False)),
            "unclear_boolean",
            "warning",
        ),
        (F.length(value) > 1000, "very_long_text", "warning"),
    ]
    if "items" in updates.columns:
        tests.append((F.size("items") > 50, "very_long_list", "warning"))
    found = F.array_compact(
        F.array(
            *[
                F.when(t, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
                for t, code, severity in tests
            ]
        )
    )
    return updates.select(key, F.inline(found))


_TYPES = ("numeric", "date", "boolean", "text")


def profile_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows, filled rows, fill rate and most frequent value type per field, in one pass."""
    per_field = []
    for name in fields:
        c = F.col(f"`{name}`").cast("string")
        filled = S.has_value(c)
        kinds = [F.count_if(filled & (S.guess_value_type(c) == t)) for t in _TYPES]
        ranked = F.array(
            *[
                F.struct(n.alias("n"), F.lit(-i).alias("order"), F.lit(t).alias("type"))
                for i, (t, n) in enumerate(zip(_TYPES, kinds))
            ]
        )
        most = F.array_max(ranked)
        per_field.append(
            F.struct(
                F.lit(name).alias("field"),
                rows().alias("checked"),
                F.count_if(filled).alias("with_value"),
                safe_ratio(F.count_if(filled), rows(), 100.0).alias("fill_rate"),
                F.when(most["n"] > 0, most["type"]).alias("inferred_type"),
            )
        )
    return df.agg(F.array(*per_field).alias("s")).select(F.inline("s"))


def sample_values(df: DataFrame, fields: Sequence[str], k: int = 3) -> DataFrame:
    """First k distinct filled values per field in order.

    Values are made distinct before the ranking, and the ranking keeps k rows per field and task.
    """
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields]
    )
    values = df.select(F.inline(pairs)).where(S.has_value(F.col("value"))).distinct()
    order = Window.partitionBy("field").orderBy("value")
    return values.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def discover_fields(catalog: DataFrame) -> DataFrame:
    """Fields per resource, name pattern and likely type; fields without a pattern count as none."""
    described = catalog.select("resource", S.field_name_category(F.col("field")).alias("c"))
    names = F.when(F.size("c.categories") == 0, F.array(F.lit("none"))).otherwise(F.col("c.categories"))
    return (
        described.select("resource", F.col("c.likely_type").alias("likely_type"), F.explode(names).alias("pattern"))
        .groupBy("resource", "pattern", "likely_type")
        .agg(rows().alias("fields"))
    )


def bulk_validate(
    df: DataFrame, values: Mapping[str, str], fields: Sequence[FieldMeta], key: str
) -> DataFrame:
    """Issues of the same given values for every selected row."""
    given = df.select(key, *[F.lit(v).cast("string").alias(n) for n, v in values.items()])
    return validate_fields(given, [m for m in fields if m.name in values], key)
