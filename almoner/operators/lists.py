"""List filters per resource: equality on given columns plus an optional date span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.functions.predicates import literal
from almoner.operators.paging import limit

USER_TYPES = ("INDIVIDUAL", "COMPANY")


def filter_rows(
    df: DataFrame,
    equal: Mapping[str, Any],
    date_column: str | None = None,
    start: Any = None,
    end: Any = None,
) -> DataFrame:
    """Rows equal to every given (non-None) value and dated within [start, end]."""
    out = df
    for name, value in equal.items():
        if value is not None:
            out = out.where(F.col(name) == literal(value))
    if start is not None:
        out = out.where(F.col(date_column) >= literal(start))
    if end is not None:
        out = out.where(F.col(date_column) <= literal(end))
    return out


def list_accounts(
    df: DataFrame,
    user_type: str,
    email: str | None = None,
    first: str | None = None,
    last: str | None = None,
    limit_rows: int | None = None,
    pk: str = "account_id",
) -> DataFrame:
    """Accounts of one required user type; the limit counts rows after the type filter."""
    if user_type not in USER_TYPES:
        raise ValueError(f"user_type must be one of {USER_TYPES}, not {user_type!r}")
    out = filter_rows(
        df, {"user_type": user_type, "email": email, "first_name": first, "last_name": last}
    )
    return out if limit_rows is None else limit(out, limit_rows, pk)


def list_events(df, status=None, category_id=None, start=None, end=None):
    return filter_rows(df, {"status": status, "category_id": category_id}, "start_date", start, end)


def list_campaigns(df, status=None, type=None):
    return filter_rows(df, {"status": status, "type": type})


def list_memberships(df, status=None, type_id=None, start=None, end=None):
    return filter_rows(df, {"status": status, "type_id": type_id}, "term_start", start, end)


def list_recurring(df, status=None, frequency=None, campaign_id=None, start=None, end=None):
    equal = {"status": status, "frequency": frequency, "campaign_id": campaign_id}
    return filter_rows(df, equal, "start_date", start, end)


def list_soft_credits(df, donation_id=None, account_id=None, campaign_id=None, start=None, end=None):
    equal = {"donation_id": donation_id, "account_id": account_id, "campaign_id": campaign_id}
    return filter_rows(df, equal, "date", start, end)


def list_grants(df, status=None, funder=None, start=None, end=None):
    return filter_rows(df, {"status": status, "funder": funder}, "start_date", start, end)


def list_households(df, name=None):
    return filter_rows(df, {"name": name})


def list_orders(df, status=None, start=None, end=None):
    return filter_rows(df, {"status": status}, "date", start, end)


def list_payments(df, status=None, method=None, start=None, end=None):
    return filter_rows(df, {"status": status, "method": method}, "date", start, end)


def list_pledges(df, campaign_id=None, fund_id=None, status=None, start=None, end=None):
    equal = {"campaign_id": campaign_id, "fund_id": fund_id, "status": status}
    return filter_rows(df, equal, "date", start, end)


def list_volunteers(df, status=None, skill_id=None, availability=None):
    return filter_rows(df, {"status": status, "skill_id": skill_id, "availability": availability})


def list_products(df, status=None, category_id=None):
    return filter_rows(df, {"status": status, "category_id": category_id})


def list_transactions(df, status=None, start=None, end=None):
    return filter_rows(df, {"status": status}, "date", start, end)


def list_store_orders(df, status=None, customer_id=None):
    return filter_rows(df, {"status": status, "customer_id": customer_id})


def list_custom_objects(df, type=None, status=None):
    return filter_rows(df, {"type": type, "status": status})


def list_custom_fields(df: DataFrame, category: str | None = None) -> DataFrame:
    """Fields of one category (component), or of all of them."""
    return filter_rows(df, {"component": category})


def find_field(df: DataFrame, name: str, category: str | None = None) -> DataFrame:
    return filter_rows(df, {"name": name, "component": category})


def list_groups(df: DataFrame, category: str | None = None) -> DataFrame:
    return list_custom_fields(df, category).select("group_name", "component").distinct()


def field_options(custom_fields: DataFrame) -> DataFrame:
    """Option values of every selection field, one row each."""
    return custom_fields.select(
        F.col("name").alias("field"), F.posexplode("option_values").alias("position", "o")
    ).select("field", "position", F.col("o.id").alias("option_id"), F.col("o.name").alias("option"))


def membership_levels(df: DataFrame, level: str = "level") -> DataFrame:
    return df.select(level).where(F.col(level).isNotNull()).distinct()


def list_registrations(
    df: DataFrame,
    event_id: Any,
    registrant: Any = None,
    sort_column: str = "registration_id",
    direction: str = "ASC",
    limit_rows: int | None = None,
) -> DataFrame:
    """Registrations of one event, sorted; the limit needs the sort, so both are applied together."""
    out = filter_rows(df, {"event_id": event_id, "account_id": registrant})
    order = F.desc(sort_column) if direction.upper() == "DESC" else F.asc(sort_column)
    out = out.orderBy(order, "registration_id")
    return out if limit_rows is None else out.limit(limit_rows)


def nested_rows(df: DataFrame, parent_key: str, value: Any, columns: Sequence[str] = ()) -> DataFrame:
    """Children of one parent."""
    out = df.where(F.col(parent_key) == literal(value))
    return out.select(*columns) if columns else out
