"""Roles, overrides and permissions as tables, and the gate in front of reads and writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Resources, permissions and what each role may do.
PERMISSIONS = ("read", "write", "update", "delete", "admin")
RESOURCES = (
    "accounts",
    "activities",
    "addresses",
    "campaigns",
    "custom_fields",
    "custom_objects",
    "donations",
    "events",
    "grants",
    "households",
    "memberships",
    "online_store",
    "orders",
    "payments",
    "pledges",
    "properties",
    "recurring_donations",
    "soft_credits",
    "volunteers",
    "webhooks",
)
_EDIT = ("read", "write", "update")
_FULL = ("read", "write", "update", "delete")
# Resources a role may do more on than read; everything else is read-only.
ROLE_GRANTS: dict[str, dict[tuple[str, ...], tuple[str, ...]]] = {
    "viewer": {},
    "editor": {
        (
            "accounts",
            "activities",
            "addresses",
            "campaigns",
            "donations",
            "events",
            "grants",
            "households",
            "memberships",
            "online_store",
            "pledges",
            "recurring_donations",
            "soft_credits",
            "volunteers",
        ): _EDIT,
        ("orders", "payments"): ("read", "update"),
    },
    "admin": {RESOURCES: ("admin",)},
    "fundraiser": {
        (
            "accounts",
            "activities",
            "addresses",
            "campaigns",
            "donations",
            "grants",
            "pledges",
            "recurring_donations",
            "soft_credits",
        ): _EDIT,
    },
    "event_manager": {
        ("events",): _FULL,
        ("accounts", "activities", "addresses", "volunteers"): _EDIT,
    },
    "volunteer_coordinator": {
        ("volunteers",): _FULL,
        ("accounts", "activities", "addresses"): _EDIT,
    },
}
_MATRIX = "role string, resource string, permission string"


def role_matrix(spark: SparkSession) -> DataFrame:
    """role, resource, permission; admin stands for everything."""
    cells = []
    for role, grants in ROLE_GRANTS.items():
        more = {resource: given for group, given in grants.items() for resource in group}
        for resource in RESOURCES:
            cells.extend((role, resource, p) for p in more.get(resource, ("read",)))
    return spark.createDataFrame(cells, _MATRIX)


def override_roles(matrix: DataFrame, overrides: DataFrame) -> DataFrame:
    """Role overrides (role, resource, permission) replace the role's set for that resource."""
    touched = overrides.select("role", "resource").distinct()
    return matrix.join(touched, ["role", "resource"], "left_anti").unionByName(
        overrides.select("role", "resource", "permission").where(F.col("permission").isNotNull())
    )


def effective_permissions(users: DataFrame, matrix: DataFrame, overrides: DataFrame) -> DataFrame:
    """Permissions per user and resource; a user's override replaces the role's set for a resource.

    An override row with a null permission takes the resource away.
    """
    touched = overrides.select("user_id", "resource").distinct()
    by_role = users.select("user_id", "role").join(matrix, "role")
    kept = by_role.join(touched, ["user_id", "resource"], "left_anti")
    own = overrides.where(F.col("permission").isNotNull())
    return kept.select("user_id", "resource", "permission").unionByName(
        own.select("user_id", "resource", "permission").distinct()
    )


def users_with(perms: DataFrame, resource: str, permission: str) -> DataFrame:
    """Users who hold a permission on a resource, directly or as admin."""
    held = perms.where(
        (F.col("resource") == resource) & F.col("permission").isin(permission, "admin")
    )
    return held.select("user_id").distinct()


def allowed(users: DataFrame, perms: DataFrame, asked: Sequence[tuple[str, str]]) -> DataFrame:
    """user_id, resource, permission, allowed: for every user each asked (resource, permission)."""
    wanted = F.array(*[F.struct(F.lit(r).alias("resource"), F.lit(p).alias("permission")) for r, p in asked])
    held = perms.groupBy("user_id", "resource").agg(F.collect_set("permission").alias("__held"))  # five names at most
    rows = users.select("user_id", F.inline(wanted)).join(held, ["user_id", "resource"], "left")
    has = F.array_contains("__held", F.col("permission")) | F.array_contains("__held", F.lit("admin"))
    return rows.select("user_id", "resource", "permission", F.coalesce(has, F.lit(False)).alias("allowed"))


def require(perms: DataFrame, user: object | None, resource: str, permission: str) -> None:
    """Raise PermissionError unless `user` holds the permission. Without a user nothing is allowed."""
    if user is None:
        raise PermissionError("no user context")
    found = users_with(perms.where(F.col("user_id") == user), resource, permission)
    if found.isEmpty():
        raise PermissionError(f"user {user!r} lacks {permission} on {resource}")


def row_rule(df: DataFrame, role: str, rules: Mapping[str, str]) -> DataFrame:
    """Optional row predicate (SQL text) for a role; roles without a rule see every row."""
    return df.where(rules[role]) if role in rules else df
