"""Limits, key order, pages and top rows. Every cut has a unique order behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.operators.ranks import global_rank
from almoner.operators.search import Request, search


def limit(df: DataFrame, n: int, pk: str) -> DataFrame:
    return df.orderBy(pk).limit(n)


def key_order(pk: str) -> list[Column]:
    """Digit-only keys by number first, then the others in lower case."""
    text = F.col(pk).cast("string")
    digits = text.rlike("^[0-9]+$")
    return [
        F.when(digits, 0).otherwise(1).asc(),
        F.when(digits, text.try_cast("decimal(38,0)")).asc(),
        F.lower(text).asc(),
        text.asc(),
    ]


def order_by_key(df: DataFrame, pk: str) -> DataFrame:
    return df.orderBy(*key_order(pk))


def _check_size(size: int) -> None:
    if not 1 <= size <= 500:
        raise ValueError(f"page size must be between 1 and 500, not {size}")


def page_after(df: DataFrame, pk: str, last: object | None, size: int) -> DataFrame:
    """Next page after key `last`; each page reads only the rows behind it."""
    _check_size(size)
    rest = df if last is None else df.where(F.col(pk) > last)
    return rest.orderBy(pk).limit(size)


def page(df: DataFrame, pk: str, number: int, size: int) -> DataFrame:
    """Page by 0-based number, found by the global rank of the unique key."""
    _check_size(size)
    if number < 0:
        raise ValueError("page number must not be negative")
    # the keys alone are ranked; their bounds then reach the scan of the whole rows
    first = number * size
    ranked = global_rank(df.select(pk), [F.asc(pk)], "__rank")
    bounds = ranked.where(F.col("__rank").between(first + 1, first + size)).agg(F.min(pk).alias("low"), F.max(pk).alias("high"))
    found = bounds.first()
    return df.where("false") if found["low"] is None else df.where(F.col(pk).between(found["low"], found["high"]))


def page_numbers(df: DataFrame, pk: str, size: int) -> DataFrame:
    """Every row with its 0-based page number."""
    _check_size(size)
    ranked = global_rank(df, [F.asc(pk)], "__rank")
    number = F.floor((F.col("__rank") - 1) / size)
    return ranked.withColumn("page", number).drop("__rank")


def page_stats(df: DataFrame, size: int) -> DataFrame:
    _check_size(size)
    return df.agg(F.count(F.lit(1)).alias("total_results")).withColumn(
        "total_pages", F.ceil(F.col("total_results") / size)
    )


def search_paginated(
    df: DataFrame, request: Request, pk: str, page_size: int = 50, max_pages: int | None = None
) -> DataFrame:
    """Search results cut after max_pages full pages."""
    _check_size(page_size)
    found = search(df, request)
    return found if max_pages is None else limit(found, page_size * max_pages, pk)


def sort(df: DataFrame, field: str, direction: str = "ASC", tie: Sequence[str] = ()) -> DataFrame:
    if direction.upper() not in ("ASC", "DESC"):
        raise ValueError(f"direction must be ASC or DESC, not {direction!r}")
    order = F.desc(field) if direction.upper() == "DESC" else F.asc(field)
    return df.orderBy(order, *tie)


def top_n(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(metric), F.asc(tie)).limit(n)


def argmax(df: DataFrame, metric: str, key: str) -> DataFrame:
    """The row with the largest metric; the smallest key wins a tie."""
    return top_n(df, metric, 1, key)


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key by `order`, then by the row itself, combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    line = F.struct(F.struct(*order).alias("__order"), F.struct(*rest).alias("__row"))
    picked = df.groupBy(key).agg(F.min(line).alias("__first")).select(key, "__first.__row")
    return picked.select(key, "__row.*").select(*df.columns)
