"""Resource registry: the key of every resource and the declared schema of the main ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Primary keys; every other resource uses id.
PRIMARY_KEYS = {
    "accounts": "accountId",
    "donations": "donationId",
    "events": "eventId",
    "activities": "activityId",
    "memberships": "membershipId",
    "attendees": "attendeeId",
    "individuals": "individualId",
    "companies": "companyId",
    "products": "productId",
    "prospects": "prospectId",
    "grants": "grantId",
    "households": "householdId",
    "pledges": "pledgeId",
    "recurring_donations": "recurringDonationId",
    "soft_credits": "softCreditId",
    "orders": "orderId",
    "payments": "paymentId",
    "volunteers": "volunteerId",
}
_PAIR = "struct<id:string,name:string>"
SCHEMAS = {
    "accounts": (
        "accountId string, firstName string, lastName string, companyName string, email string, "
        "phone string, userType string, dateCreated string, dateModified string, addresses array<"
        "struct<addressType:string,streetAddress1:string,city:string,state:string,zipCode:string,"
        "country:string>>"
    ),
    "donations": (
        f"donationId string, accountId string, amount decimal(18,2), date string, campaign {_PAIR}, "
        f"fund {_PAIR}, purpose {_PAIR}, source {_PAIR}, status string, payments array<"
        "struct<id:string,amount:decimal(18,2),method:string>>"
    ),
    "events": (
        f"eventId string, name string, startDate string, endDate string, status string, category {_PAIR}"
    ),
    "campaigns": (
        "id string, name string, goal string, startDate string, endDate string, status string, type string"
    ),
    "memberships": (
        f"membershipId string, accountId string, membershipLevel {_PAIR}, membershipTerm {_PAIR}, "
        "fee decimal(18,2), transactionDate string, termStartDate string, termEndDate string, status string"
    ),
    "recurring_donations": (
        f"recurringDonationId string, accountId string, amount decimal(18,2), frequency string, "
        f"status string, campaign {_PAIR}, startDate string, endDate string"
    ),
    "soft_credits": (
        f"softCreditId string, donationId string, accountId string, amount decimal(18,2), "
        f"campaign {_PAIR}, date string"
    ),
    "pledges": (
        f"pledgeId string, accountId string, amount decimal(18,2), campaign {_PAIR}, fund {_PAIR}, "
        "status string, date string"
    ),
    "grants": (
        "grantId string, name string, funder string, amount decimal(18,2), status string, "
        "startDate string, endDate string"
    ),
    "households": "householdId string, name string, members array<string>",
    "orders": "orderId string, accountId string, total decimal(18,2), status string, date string",
    "payments": (
        "paymentId string, donationId string, amount decimal(18,2), method string, status string, date string"
    ),
    "volunteers": (
        "volunteerId string, accountId string, status string, skills array<string>, availability string, "
        "volunteerGroup string, volunteerRole string, assignedOpportunities string"
    ),
    "custom_fields": (
        "id string, name string, displayType string, dataType string, status string, component string, "
        f"groupName string, required boolean, optionValues array<{_PAIR}>"
    ),
}
# Reference lists offered as plain id/name tables.
PROPERTY_LISTS = (
    "activity-statuses",
    "address-types",
    "company-types",
    "countries",
    "current-system-user",
    "event-categories",
    "event-topics",
    "funds",
    "genders",
    "individual-types",
    "organization-profile",
    "prefixes",
    "purposes",
    "relation-types",
    "solicitation-methods",
    "sources",
    "state-provinces",
    "system-timezones",
    "system-users",
)


def primary_key(resource: str) -> str:
    return PRIMARY_KEYS.get(resource, "id")


def schema_of(resource: str) -> T.StructType:
    if resource not in SCHEMAS:
        raise KeyError(f"no declared schema for {resource!r}")
    return T.StructType.fromDDL(SCHEMAS[resource])


def read_resource(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read a resource with its declared schema, or one given by the caller."""
    if fmt not in ("parquet", "json", "csv", "orc"):
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.format(fmt).options(**options)
    wanted = schema if schema is not None else (schema_of(name) if name in SCHEMAS else None)
    if wanted is not None:
        reader = reader.schema(wanted)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} input needs a schema; none is declared for {name!r}")
    return reader.load(path)


def properties(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One reference list from `folder`, as an id/name table."""
    if name not in PROPERTY_LISTS:
        raise ValueError(f"unknown list {name!r}; known: {PROPERTY_LISTS}")
    return read_resource(spark, f"{folder}/{name}.{fmt}", fmt=fmt, schema="id string, name string")


def get_by_key(df: DataFrame, pk: str, value: object) -> DataFrame:
    return df.where(F.col(pk) == value)
