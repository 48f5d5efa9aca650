"""The search language: AND-ed predicates, output columns, renaming and request checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.predicates import NO_VALUE, OPERATORS, literal, predicate
from almoner.functions.scalars import loose_date_ok

Request = Mapping[str, Any]

# Display names and the column they stand for.
DISPLAY_TO_API = {
    "Account ID": "accountId",
    "First Name": "firstName",
    "Last Name": "lastName",
    "Email 1": "email1",
    "Email 2": "email2",
    "Email 3": "email3",
    "Phone 1": "phone1",
    "Phone 2": "phone2",
    "Phone 3": "phone3",
    "Account Type": "accountType",
    "Company Name": "companyName",
    "Date Created": "dateCreated",
    "Date Modified": "dateModified",
    "Source": "source",
    "Login Name": "loginName",
    "Address Line 1": "addressLine1",
    "Address Line 2": "addressLine2",
    "City": "city",
    "State": "stateProvince",
    "State/Province": "stateProvince",
    "Zip Code": "zipCode",
    "Country": "country",
    "Gender": "gender",
    "Date of Birth": "dateOfBirth",
    "Preferred Name": "preferredName",
    "Account Created Date/Time": "dateCreated",
    "Account Last Modified Date/Time": "dateModified",
    "Donation ID": "id",
    "Donation Amount": "amount",
    "Amount": "amount",
    "Donation Date": "date",
    "Date": "date",
    "Campaign": "campaign",
    "Campaign Name": "name",
    "Campaign ID": "id",
    "Fund": "fund",
    "Purpose": "purpose",
    "Payment Method": "paymentMethod",
    "Check Number": "checkNumber",
    "Transaction Fee": "transactionFee",
    "Anonymous Type": "anonymousType",
    "Tribute Type": "tributeType",
    "Acknowledgee": "acknowledgee",
    "Note": "note",
    "Tender Type": "paymentMethod",
    "Event ID": "id",
    "Event Name": "name",
    "Start Date": "startDate",
    "End Date": "endDate",
    "Category": "category",
    "Status": "status",
    "Published": "publishEvent",
    "Archived": "archived",
    "Registration Start Date": "registrationStartDate",
    "Registration End Date": "registrationEndDate",
    "Maximum Attendees": "maximumAttendees",
    "Current Attendees": "currentAttendees",
    "Summary": "summary",
    "Description": "description",
    "Activity ID": "id",
    "Activity Type": "activityType",
    "Subject": "subject",
    "Priority": "priority",
    "Assigned To": "assignedTo",
    "Created By": "createdBy",
    "Membership ID": "id",
    "Membership Type": "membershipType",
    "Enrollment Date": "enrollmentDate",
    "Expiration Date": "expirationDate",
    "Auto Renew": "autoRenew",
    "Term": "term",
    "Transaction ID": "transactionId",
    "Campaign Code": "code",
    "Campaign Goal": "goal",
    "Campaign Start Date": "startDate",
    "Campaign End Date": "endDate",
    "Campaign Type": "type",
    "Campaign Status": "status",
}
# Display name of a column that has several, where it is not the first one listed.
PREFERRED_DISPLAY = {
    "id": "ID",
    "name": "Event Name",
    "date": "Date",
    "campaign": "Campaign Name",
    "stateProvince": "State/Province",
}
# Operators each field type accepts.
_ORDERED = (
    "EQUAL",
    "NOT_EQUAL",
    "BLANK",
    "NOT_BLANK",
    "LESS_THAN",
    "GREATER_THAN",
    "LESS_AND_EQUAL",
    "GREATER_AND_EQUAL",
    "IN_RANGE",
    "NOT_IN_RANGE",
)
TYPE_OPERATORS = {
    "string": ("EQUAL", "NOT_EQUAL", "BLANK", "NOT_BLANK", "CONTAIN", "NOT_CONTAIN"),
    "number": _ORDERED,
    "date": _ORDERED,
    "boolean": ("EQUAL", "NOT_EQUAL"),
    "enum": ("EQUAL", "NOT_EQUAL", "BLANK", "NOT_BLANK"),
}
STANDARD_OPERATORS = tuple(dict.fromkeys(op for ops in TYPE_OPERATORS.values() for op in ops))


def where_all(df: DataFrame, fields: Sequence[Mapping[str, Any]]) -> DataFrame:
    tests = [predicate(F.col(f"`{f['field']}`"), f["operator"], f.get("value")) for f in fields]
    return df.where(reduce(Column.__and__, tests)) if tests else df


def project(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Chosen columns; none or * means all of them."""
    if not fields or list(fields) == ["*"]:
        return df
    return df.select(*[F.col(f"`{name}`") for name in fields])


def normalise_literals(request: Request) -> dict[str, Any]:
    """Integer filter values become text, digit-only output names become integers."""
    out = dict(request)
    out["searchFields"] = [
        {**f, "value": str(f["value"])} if type(f.get("value")) is int else dict(f)
        for f in request.get("searchFields", [])
    ]
    if "outputFields" in request:
        out["outputFields"] = [
            int(n) if isinstance(n, str) and n.isdigit() else n for n in request["outputFields"]
        ]
    return out


def rename_request(request: Request, names: Mapping[str, str] = DISPLAY_TO_API) -> dict[str, Any]:
    """Display names in filters and outputs replaced by column names; others pass through."""
    out = dict(request)
    out["searchFields"] = [
        {**f, "field": names.get(f["field"], f["field"])} for f in request.get("searchFields", [])
    ]
    if "outputFields" in request:
        out["outputFields"] = [names.get(n, n) for n in request["outputFields"]]
    return out


def to_api(df: DataFrame, names: Mapping[str, str] = DISPLAY_TO_API) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def to_display(df: DataFrame, names: Mapping[str, str] = DISPLAY_TO_API) -> DataFrame:
    """The preferred display name of each column, else the first one listed."""
    back = {api: name for api, name in PREFERRED_DISPLAY.items() if names is DISPLAY_TO_API}
    for display, api in names.items():
        back.setdefault(api, display)
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


def resolve_custom_names(
    request: Request, ids_by_name: Mapping[str, str], standard: Sequence[str]
) -> dict[str, Any]:
    """Custom-field names replaced by ids; digits and standard names are left alone."""

    def resolve(name: Any) -> Any:
        if isinstance(name, int) or str(name).isdigit() or name in standard:
            return name
        return ids_by_name.get(name, name)

    out = dict(request)
    out["searchFields"] = [
        {**f, "field": str(resolve(f["field"]))} for f in request.get("searchFields", [])
    ]
    if "outputFields" in request:
        out["outputFields"] = [resolve(n) for n in request["outputFields"]]
    return out


def search(df: DataFrame, request: Request) -> DataFrame:
    """Rows passing every search field, with the requested output columns."""
    return project(
        where_all(df, request.get("searchFields", [])),
        [str(n) for n in request.get("outputFields", [])],
    )


def search_by_custom_field(
    df: DataFrame,
    ids_by_name: Mapping[str, str],
    name: str,
    value: Any = None,
    operator: str = "EQUAL",
) -> DataFrame:
    """Search on one custom field given by name."""
    request = {"searchFields": [{"field": name, "operator": operator, "value": value}]}
    return search(df, resolve_custom_names(request, ids_by_name, df.columns))


def since(
    df: DataFrame, column: str, as_of: datetime, years: int | None = None, days: int | None = None
) -> DataFrame:
    """Rows dated within the last years or days before `as_of`."""
    if (years is None) == (days is None):
        raise ValueError("give either years or days")
    now = literal(as_of)
    start = F.add_months(now, -12 * years) if years is not None else F.date_sub(now, days)
    return df.where(F.col(column) >= start.cast("timestamp_ntz"))


def validate_requests(requests: DataFrame, catalog: DataFrame, strict_range: bool = True) -> DataFrame:
    """One row per problem: request_id, part, position, code.

    `requests` has request_id, resource, search_fields array<struct<field, operator, values array<
    string>, value_type>>, output_fields array<string>, current_page and page_size. `catalog` has
    resource, field, field_type, searchable and outputable.
    """
    item = "struct<part:string,position:int,field:string,operator:string,values:array<string>,value_type:string>"
    searched = F.transform(
        "search_fields",
        lambda f, i: F.struct(
            F.lit("search").alias("part"), i.alias("position"), f["field"], f["operator"], f["values"], f["value_type"]
        ).cast(item),
    )
    no_text, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    # an absent list is filled in later and fine; an empty one is reported through its null entry
    outputs = F.coalesce("output_fields", F.array().cast("array<string>"))
    empty = F.col("output_fields").isNotNull() & (F.size(outputs) == 0)
    wanted = F.when(empty, F.array(no_text)).otherwise(outputs)
    shown = F.transform(
        wanted,
        lambda name, i: F.struct(
            F.lit("output").alias("part"), i.alias("position"), name, no_text, no_list, no_text
        ).cast(item),
    )
    paged = F.array(
        F.struct(F.lit("pagination"), F.lit(0), no_text, no_text, no_list, no_text).cast(item)
    )
    # all parts of a request become rows in one pass and meet the catalogue in one join
    parts = F.concat(F.coalesce(searched, F.array().cast(f"array<{item}>")), shown, paged)
    checked = (
        requests.select("request_id", "resource", "current_page", "page_size", F.explode(parts).alias("p"))
        .select("request_id", "resource", "current_page", "page_size", "p.*")
        .join(catalog.withColumn("listed", F.lit(True)), ["resource", "field"], "left")
        .withColumn("known", F.when(F.col("part") == "search", F.col("searchable")).otherwise(F.col("outputable")))
        .withColumn("known", F.coalesce("known", F.lit(False)))
    )
    operator, values = F.col("operator"), F.col("values")
    kind = F.coalesce(F.when(F.col("known"), F.col("field_type")), F.lit("string"))
    custom = F.col("field").rlike(r"^\d+$")
    named = F.length(F.coalesce("field", F.lit(""))) > 0
    usable = named & operator.isin(*STANDARD_OPERATORS)
    allowed = F.lit(False)
    for name, operators in TYPE_OPERATORS.items():
        allowed = allowed | ((kind == name) & operator.isin(*operators))
    no_value = operator.isin(*NO_VALUE)
    given = values.isNotNull() & (F.size(values) > 0)
    ranged = operator.isin("IN_RANGE", "NOT_IN_RANGE")
    bad_range = ranged & (F.size(values) != 2) if strict_range else F.lit(False)
    typed = usable & ~no_value & given & ~bad_range
    bad_type = (
        ((kind == "number") & (F.col("value_type") != "number"))
        | ((kind == "boolean") & (F.col("value_type") != "boolean"))
        | ((kind == "date") & ((F.col("value_type") != "string") | ~F.forall(values, loose_date_ok)))
    )
    problems = {
        "field_missing": ~named,
        "field_unknown": named & ~F.col("known") & ~custom,
        "operator_missing": named & operator.isNull(),
        "operator_unknown": named & operator.isNotNull() & ~operator.isin(*OPERATORS),
        "operator_not_allowed": usable & ~allowed,
        "value_not_wanted": usable & no_value & given,
        "value_missing": usable & ~no_value & ~given,
        "range_needs_two": usable & given & bad_range,
        "value_type": typed & bad_type,
    }
    in_search = [F.when(test, code) for code, test in problems.items()]
    in_output = [
        F.when(F.col("field").isNull(), "output_missing").when(~F.col("known") & ~custom, "field_unknown")
    ]
    in_paging = [
        F.when(F.col("current_page") < 0, "page_negative"),
        F.when(~F.col("page_size").between(1, 500), "page_size_range"),
    ]
    by_part = (
        F.when(F.col("part") == "search", F.array(*in_search))
        .when(F.col("part") == "output", F.array(*in_output))
        .otherwise(F.array(*in_paging))
    )
    return checked.select(
        "request_id", "part", "position", F.explode(F.array_compact(by_part)).alias("code")
    )
