"""K-means donor clusters and their profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.operators.aggregates import mean_of, money, rows, share_of_total
from almoner.operators.ranks import attach, exact_quantiles
from almoner.session import materialize

FEATURES = ("recency_days", "frequency", "total_donated", "avg_donation", "tenure_days", "donor_age_days")


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the column's exact median."""
    medians = exact_quantiles(df, {c: (F.col(c), 0.5) for c in columns})
    held = attach(df, medians, "__m")
    return held.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("__m")[c]) for c in columns}
    ).drop("__m")


def kmeans_donors(
    rfm: DataFrame, k: int = 6, starts: int = 10, seed: int = 42, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Donors with their cluster: median fill, standardised features, the cheapest of several starts."""
    used = [c for c in features if c in rfm.columns]
    filled = fill_medians(materialize(rfm), used)
    vectors = VectorAssembler(inputCols=used, outputCol="__raw").transform(filled)
    scaled = materialize(
        StandardScaler(inputCol="__raw", outputCol="__x", withMean=True).fit(vectors).transform(vectors)
    )
    models = [
        KMeans(k=k, seed=seed + i, featuresCol="__x", predictionCol="cluster").fit(scaled)
        for i in range(starts)
    ]
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(scaled).drop("__raw", "__x")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """One named row per cluster; names compare a cluster's means with those of the others."""
    grouped = clustered.groupBy("cluster").agg(
        rows().alias("donors"),
        money(F.col("total_donated").cast("decimal(28,2)")).alias("revenue"),
        mean_of(F.col("total_donated")).alias("avg_total_donated"),
        F.avg("avg_donation").alias("avg_gift"),
        mean_of(F.col("frequency")).alias("avg_frequency"),
        mean_of(F.col("recency_days")).alias("avg_recency"),
        mean_of(F.col("tenure_days")).alias("avg_tenure"),
    )
    # k rows, so the built-in percentile holds k values
    cuts = grouped.agg(
        F.percentile("avg_total_donated", 0.8).alias("total"),
        F.percentile("avg_frequency", 0.7).alias("frequency"),
    )
    held = attach(share_of_total(grouped, "revenue", "revenue_share"), cuts, "__c")
    major = F.col("avg_total_donated") > F.col("__c")["total"]
    name = (
        F.when(major & (F.col("avg_recency") < 180), "Major Donors - Active")
        .when(major, "Major Donors - Lapsed")
        .when(F.col("avg_frequency") > F.col("__c")["frequency"], "Frequent Givers")
        .when(F.col("avg_recency") < 90, "Recent Donors")
        .when(F.col("avg_recency") > 730, "Dormant Donors")
        .otherwise("Occasional Donors")
    )
    return held.withColumn("cluster_name", name).drop("__c")
