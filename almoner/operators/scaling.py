"""Scaling a column against the whole frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.operators.ranks import attach


def scale_to_100(df: DataFrame, column: str, out: str) -> DataFrame:
    """Column as a share of its maximum, which becomes 100; all 0 when the maximum is 0."""
    held = attach(df, df.agg(F.max(column).alias("m")), "__m")
    top = F.col("__m")["m"]
    value = F.try_divide(F.col(column) * 100.0, top)
    return held.withColumn(out, F.when(top == 0, 0.0).otherwise(value)).drop("__m")
