"""Set operations on keys and lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.operators.paging import first_per_key


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def keys_in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return distinct_keys(a, key).join(distinct_keys(b, key), key, "left_semi")


def keys_only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return distinct_keys(a, key).join(distinct_keys(b, key), key, "left_anti")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by `order`."""
    return first_per_key(df, key, order)
