"""Turning raw pages and text columns into typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.functions.scalars import flatten_pair_expr, parse_date


def unwrap_pages(df: DataFrame, key: str, item_schema: str, body: str = "body") -> DataFrame:
    """Rows of JSON pages whose payload sits under `key`, searchResults, data, or is a bare list."""
    items = f"array<{item_schema}>"
    wrapped = F.from_json(
        F.col(body), f"struct<`{key}`:{items},searchResults:{items},data:{items}>"
    )
    bare = F.when(F.startswith(F.ltrim(F.col(body)), F.lit("[")), F.from_json(F.col(body), items))
    payload = F.coalesce(bare, wrapped[key], wrapped["searchResults"], wrapped["data"])
    return df.select(F.explode(payload).alias("item")).select("item.*")


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; unreadable values become null. Dates accept all known layouts."""
    changed = {}
    for name, target in types.items():
        if target in ("timestamp", "timestamp_ntz", "date"):
            changed[name] = parse_date(F.col(name).cast("string")).cast(target)
        else:
            changed[name] = F.col(name).cast("string").try_cast(target)
    return df.withColumns(changed)


def flatten_pair(df: DataFrame, column: str) -> DataFrame:
    """Replace an id/name struct by its name, else its id."""
    return df.withColumn(column, flatten_pair_expr(F.col(column)))


def flatten_nested(df: DataFrame, key: str, column: str) -> DataFrame:
    """Child table of an array column, one row per element with the parent key."""
    return df.select(key, F.posexplode(column).alias("position", "__child")).select(
        key, "position", "__child.*"
    )
