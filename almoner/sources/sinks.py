"""Exports, change sets and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.predicates import op_not_blank
from almoner.functions.scalars import full_name

# Columns of the prospect export, in order.
PROSPECT_COLUMNS = (
    "account_id",
    "name",
    "account_type",
    "score",
    "prospect_category",
    "suggested_ask",
    "city",
    "state",
    "email",
)


def contact_export(accounts: DataFrame) -> DataFrame:
    """id, trimmed full name, email, phone and creation date as text; nulls become empty."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    return accounts.select(
        "account_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        text("email").alias("email"),
        text("phone").alias("phone"),
        text("created").alias("created"),
    )


def prospect_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in PROSPECT_COLUMNS if c in df.columns])


def export_prospects(df: DataFrame, path: str) -> None:
    prospect_columns(df).write.mode("overwrite").option("header", True).csv(path)


def opportunity_count(c: Column) -> Column:
    """Entries of a comma list after trimming and dropping empties."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.size(parts), F.lit(0))


def volunteer_export(volunteers: DataFrame) -> DataFrame:
    """Volunteer rows with participation flags, the opportunity count and the 0-3 score."""
    flag = lambda name: op_not_blank(F.col(name)).cast("int")
    out = volunteers.withColumns(
        {
            "has_opportunities": flag("assigned_opportunities"),
            "has_group": flag("volunteer_group"),
            "has_role": flag("volunteer_role"),
            "opportunity_count": opportunity_count(F.col("assigned_opportunities")),
        }
    )
    score = F.col("has_opportunities") + F.col("has_group") + F.col("has_role")
    return out.withColumn("participation_score", score).withColumn(
        "is_active_participant", (score > 0).cast("int")
    )


def apply_changes(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """New version of `df` after ordered create / put / patch / delete rows.

    `changes` has the columns of `df` plus seq (unique), op and set_columns. A patch sets only the
    columns it names, so it can set null. The last create, put or delete of a key decides whether
    the row exists; patches after a delete have nothing to act on.
    """
    columns = [c for c in df.columns if c != key]
    whole = F.col("op").isin("create", "put")
    resets = whole | (F.col("op") == "delete")

    def last_set(name: str) -> Column:
        sets = whole | ((F.col("op") == "patch") & F.array_contains("set_columns", name))
        return F.max_by(F.struct("seq", F.col(name).alias("value")), F.when(sets, F.col("seq")))

    folded = changes.groupBy(key).agg(
        F.max(F.when(resets, F.col("seq"))).alias("__reset"),
        F.max_by("op", F.when(resets, F.col("seq"))).alias("__reset_op"),
        *[last_set(c).alias(f"__new_{c}") for c in columns],
    )
    joined = df.withColumn("__old", F.lit(True)).join(folded, key, "full_outer")
    kept = F.when(F.col("__reset_op").isNull(), F.col("__old")).otherwise(
        F.col("__reset_op") != "delete"
    )
    start = F.coalesce("__reset", F.lit(-1))
    values = []
    for name in columns:
        new = F.col(f"__new_{name}")
        value = F.when(new["seq"] >= start, new["value"]).when(
            F.col("__reset").isNull(), F.col(name)
        )
        values.append(value.alias(name))
    return joined.where(F.coalesce(kept, F.lit(False))).select(key, *values).select(*df.columns)


def link_edges(edges: DataFrame, add: DataFrame) -> DataFrame:
    return edges.unionByName(add.select(*edges.columns)).dropDuplicates()


def unlink_edges(edges: DataFrame, remove: DataFrame) -> DataFrame:
    return edges.join(remove.select(*edges.columns).distinct(), edges.columns, "left_anti")
