"""Cleaning, parsing and labelling rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.functions.predicates import literal, op_blank

# Accepted date layouts, in the order they are tried.
DATE_LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "y-M-d'T'H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "y-M-d H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/y"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/y"),
    (r"^\d{1,2}:\d{1,2}:\d{1,2}$", "H:m:s"),
    (r"^\d{1,2}:\d{1,2}$", "H:m"),
)
# Patterns for contact data.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
URL_PATTERN = (
    r"(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
PHONE_PATTERNS = (
    r"^\+?1?[-.\s]?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})$",
    r"^\+?[1-9]\d{1,14}$",
    r"^[0-9\-\.\s\(\)\+]+$",
)
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TRUE_WORDS = ("true", "yes", "1", "on")
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
# Field-name patterns, in the order they are reported.
NAME_PATTERNS = {
    "numeric_id": r"^\d+$",
    "prefixed_id": r"^[A-Z]-\d+$",
    "dash_separated": r"^.+\s-\s.+$",
    "custom_prefix": r"(?i)^(Custom|C-).*",
    "very_long": r"(?s)^.{51,}$",
    "has_organization": r"(?i)(org|organization|company)",
    "has_date": r"(?i)(date|time|when|created|modified)",
    "has_amount": r"(?i)(amount|cost|price|fee|total)",
}


def parse_multivalue(c: Column) -> Column:
    """Split on | when present, else on comma; trim and drop empty items. Null gives an empty list."""
    by_pipe = F.split(c, r"\|")
    by_comma = F.split(c, ",")
    parts = F.when(F.contains(c, F.lit("|")), by_pipe).otherwise(by_comma)
    items = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(items, F.array().cast("array<string>"))


def format_multivalue(c: Column, sep: str = "|") -> Column:
    return F.array_join(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""), sep)


def parse_bool(c: Column) -> Column:
    """True for true / yes / 1 / on in any case and for non-zero numbers, else false."""
    text = F.lower(c.cast("string"))
    return F.coalesce(text.isin(*TRUE_WORDS), F.lit(False))


def number_to_bool(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def read_number(c: Column) -> Column:
    """Plain decimal or exponent notation as double, else null."""
    text = F.trim(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_number(c: Column, whole: bool = False) -> Column:
    """Empty or unreadable numbers become 0; whole numbers are cut towards zero."""
    value = F.coalesce(read_number(c), F.lit(0.0))
    return value.cast("bigint") if whole else value


def clean_number(c: Column) -> Column:
    """Number after removing , $ and %; null when nothing readable is left."""
    return read_number(F.translate(c, ",$%", ""))


def parse_date(c: Column) -> Column:
    """First matching layout wins; times alone fall on 1970-01-01."""
    text = F.trim(c)
    tries = [
        F.when(
            text.rlike(pattern), F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")
        )
        for pattern, layout in DATE_LAYOUTS
    ]
    return F.coalesce(*tries)


def loose_date_ok(c: Column) -> Column:
    """Three whole numbers joined by -, year 1900-9999, month 1-12, day 1-31 (31 February passes)."""
    part = [F.regexp_extract(c, r"^\s*(\d+)\s*-\s*(\d+)\s*-\s*(\d+)\s*$", i) for i in (1, 2, 3)]
    year, month, day = [p.try_cast("int") for p in part]
    ok = year.between(1900, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.coalesce(ok, F.lit(False))


def format_value(c: Column, display_type: str) -> Column:
    """Typed value as stored text; null becomes empty."""
    if display_type in ("Currency", "Percentage"):
        text = c.cast("decimal(18,2)").cast("string")
    elif display_type == "Number":
        text = c.cast("double").cast("string")
    elif display_type == "Date":
        text = F.date_format(c, "yyyy-MM-dd")
    elif display_type == "Time":
        text = F.date_format(c, "HH:mm:ss")
    elif display_type == "DateTime":
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    elif display_type == "YesNo":
        text = F.when(c, "true").otherwise("false")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def email_ok(c: Column) -> Column:
    return F.trim(c).rlike(EMAIL_PATTERN)


def url_ok(c: Column) -> Column:
    return F.trim(c).rlike(URL_PATTERN)


def phone_ok(c: Column) -> Column:
    text = F.trim(c)
    return text.rlike(PHONE_PATTERNS[0]) | text.rlike(PHONE_PATTERNS[1]) | text.rlike(PHONE_PATTERNS[2])


def has_control_chars(c: Column) -> Column:
    return c.rlike(CONTROL_CHARS)


def privacy_band(c: Column) -> Column:
    return (
        F.when(c < 100, "Small")
        .when(c < 1000, "Medium")
        .when(c < 10000, "Large")
        .when(c.isNotNull(), "Major")
    )


def _time_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days, rounded down, without passing through a time zone."""
    not_full = F.when(_time_of_day(later) < _time_of_day(earlier), 1).otherwise(0)
    return (F.datediff(later, earlier) - not_full).cast("bigint")


def days_since(c: Column, as_of: datetime) -> Column:
    return days_between(literal(as_of), c)


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def type_flags(c: Column) -> dict[str, Column]:
    """0/1 flags by substring, in either of the two accepted spellings."""
    return {
        "is_individual": F.coalesce(c.rlike("Individual|INDIVIDUAL"), F.lit(False)).cast("int"),
        "is_company": F.coalesce(c.rlike("Company|COMPANY"), F.lit(False)).cast("int"),
        "is_household": F.coalesce(c.rlike("Household|HOUSEHOLD"), F.lit(False)).cast("int"),
    }


def field_name_category(c: Column) -> Column:
    """Matching name patterns, the likely value type and its confidence."""
    hit = {name: c.rlike(pattern) for name, pattern in NAME_PATTERNS.items()}
    names = F.array_compact(F.array(*[F.when(h, F.lit(name)) for name, h in hit.items()]))
    text_like = hit["dash_separated"] | hit["custom_prefix"]

    def pick(identifier: Any, date: Any, number: Any, text: Any, long: Any, none: Any) -> Column:
        return (
            F.when(hit["numeric_id"], identifier)
            .when(hit["has_date"], date)
            .when(hit["has_amount"], number)
            .when(text_like, text)
            .when(hit["very_long"], long)
            .otherwise(none)
        )

    return F.struct(
        names.alias("categories"),
        pick("identifier", "date", "number", "text", "text", "unknown").alias("likely_type"),
        pick(0.9, 0.8, 0.8, 0.7, 0.6, 0.0).alias("confidence"),
    )


def looks_custom(c: Column) -> Column:
    return F.coalesce(
        c.startswith("V-")
        | c.startswith("C-")
        | c.startswith("Custom")
        | F.contains(c, F.lit(" - "))
        | (F.length(c) > 50),
        F.lit(False),
    )


def guess_value_type(c: Column) -> Column:
    """numeric, date, boolean or text, tested in that order; blank values have no type."""
    text = c.cast("string")
    digits = F.translate(text, ".-", "")
    return (
        F.when(text.isNull() | (text == ""), F.lit(None))
        .when(digits.rlike(r"^\d+$"), "numeric")
        .when((F.length(text) == 10) & F.contains(text, F.lit("-")), "date")
        .when(F.lower(text).isin("true", "false", "yes", "no"), "boolean")
        .otherwise("text")
    )


def has_value(c: Column) -> Column:
    """Neither null, empty nor a single space."""
    return c.isNotNull() & ~c.cast("string").isin("", " ")


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", first, last))


def flatten_pair_expr(pair: Column, text: Column | None = None) -> Column:
    """Name of an id/name pair, else its id, else plain text."""
    options: list[Column] = [pair["name"], pair["id"].cast("string")]
    if text is not None:
        options.append(text.cast("string"))
    return F.coalesce(*options)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[F.when(~op_blank(c), c) for c in columns])


def bucket(c: Column, edges: Sequence[tuple[Column, str]]) -> Column:
    """Label of the first condition that holds; null when none does."""
    out: Column | None = None
    for condition, label in edges:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    if out is None:
        raise ValueError("bucket needs at least one edge")
    return out


# Display types and the Spark type of their values.
DISPLAY_TYPES = {
    "Text": "string",
    "OneLineText": "string",
    "MultiLineText": "string",
    "Email": "string",
    "URL": "string",
    "Phone": "string",
    "Password": "string",
    "Number": "bigint",
    "Currency": "decimal(18,2)",
    "Percentage": "double",
    "Date": "date",
    "DateTime": "timestamp_ntz",
    "Time": "string",
    "Checkbox": "array<string>",
    "YesNo": "boolean",
    "DropDown": "string",
    "Dropdown": "string",
    "MultiSelect": "array<string>",
    "RadioButton": "string",
    "Radio": "string",
    "File": "string",
    "Image": "string",
    "Account": "string",
}
# Data types that, when known, take precedence over the display type.
DATA_TYPES = {
    "String": "string",
    "Text": "string",
    "Email": "string",
    "Phone": "string",
    "Area_Code": "string",
    "Name": "string",
    "Integer": "bigint",
    "Whole_Number": "bigint",
    "Decimal": "double",
    "Float": "double",
    "Currency": "decimal(18,2)",
    "Boolean": "boolean",
    "Date": "date",
    "DateTime": "timestamp_ntz",
    "Time": "string",
    "Array": "array<string>",
}


def spark_type(display_type: str | None, data_type: str | None = None) -> str:
    return DATA_TYPES.get(data_type or "") or DISPLAY_TYPES.get(display_type or "") or "string"


def typed_value(c: Column, display_type: str, data_type: str | None = None) -> Column:
    """Struct of the converted value and the raw text; the value is null when it cannot convert."""
    target = spark_type(display_type, data_type)
    if target == "array<string>":
        value = F.when(c.isNotNull(), parse_multivalue(c))
    elif target == "boolean":
        value = F.when(c.isNotNull(), parse_bool(c))
    elif target in ("date", "timestamp_ntz"):
        value = parse_date(c).cast(target)
    elif target == "string":
        value = c
    else:
        value = F.trim(c).try_cast(target)
    return F.struct(value.alias("value"), c.alias("raw"))
