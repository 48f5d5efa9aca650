"""Query registry. A query takes a `Crm` and returns a DataFrame; its SQL runs on the raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.plans.standins import PRELUDE, Crm

_QUERIES: dict[str, Callable[[Crm], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query. SQL is the body after the shared stand-in CTEs; it may start with WITH."""

    def add(fn: Callable[[Crm], DataFrame]) -> Callable[[Crm], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            body = sql.strip()
            more = body[:5].upper() == "WITH "
            _SQL[name] = PRELUDE + (",\n" + body[5:] if more else "\n" + body)
        return fn

    return add


def _load() -> None:
    from almoner.plans import (  # noqa: F401
        aggregate_queries,
        feature_queries,
        field_queries,
        join_queries,
        search_queries,
        segment_queries,
        text_queries,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {
        name: (lambda spark, sf_dir, fn=fn: fn(Crm(spark, sf_dir))) for name, fn in _QUERIES.items()
    }


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round computed doubles for display, so that summation order cannot show."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def as_text(c: Column) -> Column:
    return F.array_join(c, "|")
