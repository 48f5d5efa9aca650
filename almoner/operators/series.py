"""Yearly and monthly series: retention, growth, cumulative curves and wide yearly tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almoner.operators.aggregates import money, rows, safe_ratio
from almoner.operators.joins import donor_years, pairs_of_years
from almoner.operators.ranks import attach, prefix_sum, value_cuts
from almoner.session import materialize


def pareto(metrics: DataFrame, total: str = "total_donated") -> DataFrame:
    """Donors by total, largest first, with the running sum and its share of everything."""
    cents = materialize(
        metrics.select("account_id", F.col(total).cast("decimal(28,2)").alias("amount"))
    )
    running = prefix_sum(cents, "amount", [F.desc("amount"), F.asc("account_id")], "cumulative")
    held = attach(running, cents.agg(F.sum("amount").alias("t")), "__t")
    return held.select(
        "account_id",
        F.col("amount").cast("double").alias(total),
        F.col("cumulative").cast("double").alias("cumulative"),
        safe_ratio(F.col("cumulative"), F.col("__t")["t"], 100.0).alias("cumulative_share"),
    )


def annual_retention(donations: DataFrame) -> DataFrame:
    """Donors of each observed year and how many of them gave in the next observed year."""
    years = materialize(donor_years(donations))
    per_year = (
        years.select("account_id", F.explode("years").alias("year"))
        .groupBy("year")
        .agg(rows().alias("donors"))
    )
    retained = pairs_of_years(years).groupBy("year").agg(rows().alias("retained"))
    # one row per year
    following = F.lead("year").over(Window.orderBy("year"))
    return (
        per_year.join(retained, "year", "left")
        .withColumn("next_year", following)
        .where(F.col("next_year").isNotNull())
        .select("year", "next_year", "donors", F.coalesce("retained", F.lit(0)).alias("retained"))
        .withColumn("retention_rate", safe_ratio(F.col("retained"), F.col("donors"), 100.0))
    )


def year_pair(donations: DataFrame, as_of: datetime) -> DataFrame:
    """Last year against the year of `as_of`: donors, retained, new, retention and acquisition."""
    years = donor_years(donations)
    last, this = [F.array_contains("years", y) for y in (as_of.year - 1, as_of.year)]
    counted = years.agg(
        F.count_if(last).alias("donors_last_year"),
        F.count_if(this).alias("donors_this_year"),
        F.count_if(last & this).alias("retained"),
        F.count_if(this & ~last).alias("new_donors"),
    )
    return counted.withColumn(
        "retention_rate", safe_ratio(F.col("retained"), F.col("donors_last_year"), 100.0)
    ).withColumn("acquisition_rate", safe_ratio(F.col("new_donors"), F.col("donors_this_year"), 100.0))


def pct_change(series: DataFrame, value: str, order: str, out: str = "pct_change") -> DataFrame:
    """Percent change against the previous observed period; null from a zero base.

    `series` is an aggregated frame with one row per period.
    """
    before = F.lag(F.col(value).cast("double")).over(Window.orderBy(order))
    change = F.try_divide(F.col(value).cast("double") - before, before) * 100.0
    return series.withColumn(out, change)


def cumulative(series: DataFrame, value: str, order: str, out: str = "cumulative") -> DataFrame:
    """Running sum over an aggregated frame with one row per period."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumn(out, F.sum(value).over(upto))


def yearly_giving(donations: DataFrame, years: Sequence[int]) -> DataFrame:
    """One column per given year with each donor's total, 0 where nothing was given."""
    totals = [
        F.coalesce(money(F.when(F.year("date") == y, F.col("amount"))), F.lit(0.0)).alias(f"y{y}")
        for y in years
    ]
    return donations.groupBy("account_id").agg(*totals)


def yoy(donations: DataFrame, as_of: datetime) -> DataFrame:
    """Last and this year's amounts per donor and the growth, which is 0 from a zero base."""
    last, this = f"y{as_of.year - 1}", f"y{as_of.year}"
    wide = yearly_giving(donations, [as_of.year - 1, as_of.year])
    growth = safe_ratio(F.col(this) - F.col(last), F.col(last))
    return wide.select(
        "account_id",
        (F.col(last) > 0).alias("gave_last_year"),
        (F.col(this) > 0).alias("gave_this_year"),
        F.col(last).alias("last_year_amount"),
        F.col(this).alias("this_year_amount"),
        growth.alias("yoy_growth"),
    )


RECENCY_LABELS = ("Very Recent", "Recent", "Moderate", "Old", "Very Old")
MONETARY_LABELS = ("Low", "Low-Med", "Medium", "Med-High", "High")


def rm_matrix(rfm: DataFrame) -> DataFrame:
    """Donors per recency and monetary quintile, one row per recency bin."""
    columns = {"r": F.col("recency_days"), "m": F.col("total_donated")}
    held = attach(rfm, value_cuts(rfm, columns), "__c")

    def label(name: str, labels: Sequence[str]):
        value, edges = columns[name].cast("double"), F.col("__c")[name]["edges"]
        out = F.when(value <= edges[1], labels[0])
        for i in (2, 3, 4):
            out = out.when(value <= edges[i], labels[i - 1])
        return out.when(value.isNotNull(), labels[4])

    binned = held.select(
        label("r", RECENCY_LABELS).alias("recency_bin"), label("m", MONETARY_LABELS).alias("m_bin")
    )
    return (
        binned.where(F.col("recency_bin").isNotNull())
        .groupBy("recency_bin")
        .agg(*[F.count_if(F.col("m_bin") == m).alias(m.lower().replace("-", "_")) for m in MONETARY_LABELS])
    )
