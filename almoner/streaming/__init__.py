"""Resources as streams, for the operators that keep no state.

Search predicates, scalar rules, field validation and option edits are plain projections and
filters, so they run on these frames unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almoner.sources.resources import schema_of


def stream_resource(
    spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """New files of a resource folder as a stream with the declared schema."""
    return spark.readStream.format(fmt).options(**options).schema(schema_of(name)).load(path)
