"""Global ranks, prefix sums and cut points against plain Python and pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almoner.operators import ranks as R


def frame(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "k bigint, v double")


def test_global_rank_with_one_third_ties(spark):
    rng = random.Random(1)
    values = [7.0] * 400 + [rng.uniform(0, 20) for _ in range(800)]
    rng.shuffle(values)
    got = {r["k"]: r["rank"] for r in R.global_rank(frame(spark, values), [F.desc("v"), F.asc("k")]).collect()}
    want = sorted(range(len(values)), key=lambda i: (-values[i], i))
    assert got == {k: i + 1 for i, k in enumerate(want)}


def test_prefix_sum(spark):
    values = [random.Random(2).randint(0, 9) for _ in range(500)]
    got = {r["k"]: r["running"] for r in R.prefix_sum(frame(spark, values), "v", [F.asc("k")]).collect()}
    assert got == {i: float(s) for i, s in enumerate(np.cumsum(values))}


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 23, 103])
def test_quintiles_equal_qcut_of_first_rank(spark, n):
    rng = random.Random(n)
    values = [float(rng.randint(0, 3)) for _ in range(n)]
    out = R.quintiles(frame(spark, values), "k", {"up": F.col("v"), "down": F.col("v")}, reverse=["down"])
    got = out.orderBy("k").toPandas()
    want = pd.qcut(pd.Series(values).rank(method="first"), 5, labels=False) + 1
    assert list(got["up"]) == list(want)
    assert list(got["down"]) == list(6 - want)


def reference_score(series, ascending):
    try:
        labels = list(range(1, 5)) if ascending else [5, 4, 3, 2, 1]
        return pd.qcut(series, 5, labels=labels, duplicates="drop").astype(float)
    except ValueError:
        labels = [1, 2, 3, 4, 5] if ascending else [5, 4, 3, 2, 1]
        bins = [0, 0.2, 0.4, 0.6, 0.8, 1.0]
        return pd.cut(series.rank(pct=True), bins=bins, labels=labels, include_lowest=True).astype(float)


@pytest.mark.parametrize("kind", ["distinct", "ties", "four_bins", "constant"])
def test_robust_scores_equal_pandas(spark, kind):
    rng = random.Random(3)
    values = {
        "distinct": [rng.random() for _ in range(57)],
        "ties": [float(rng.randint(0, 2)) for _ in range(60)],
        "four_bins": [0.0] * 30 + [float(i) for i in range(1, 71)],
        "constant": [4.0] * 11,
    }[kind]
    out = R.robust_scores(frame(spark, values), {"up": (F.col("v"), True), "down": (F.col("v"), False)})
    got = out.orderBy("k").toPandas()
    series = pd.Series(values)
    for column, ascending in (("up", True), ("down", False)):
        want = reference_score(series, ascending)
        pd.testing.assert_series_equal(got[column], want, check_names=False)


def test_exact_quantiles_of_skewed_values(spark):
    values = [1.0] * 300 + [random.Random(4).uniform(0, 100) for _ in range(601)]
    wanted = {f"p{int(p * 100)}": (F.col("v"), p) for p in (0.0, 0.1, 0.5, 0.9, 1.0)}
    got = R.exact_quantiles(frame(spark, values), wanted).first()
    for name, (_, p) in wanted.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


@pytest.mark.parametrize("most", [3, 20_000])
@pytest.mark.parametrize("kind", ["ties", "spread", "two", "same", "one", "none"])
def test_selected_ranks_equal_a_sort(spark, kind, most):
    """Brackets that hold too many values are narrowed, brackets that miss are widened; both end at the sorted values."""
    draw = np.random.default_rng(5)
    values = {
        "ties": draw.integers(0, 5, 700), "spread": draw.normal(size=900) * 1e6, "two": np.r_[np.zeros(600), np.ones(3)],
        "same": np.repeat(4.0, 50), "one": np.array([2.5]), "none": np.array([]),
    }[kind].astype(float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)] + [(-1, None)], "k bigint, v double").repartition(3)
    probs = (0.0, 0.2, 0.5, 0.9, 1.0)
    found = R.select_ranks(df, {"a": F.col("v"), "b": -F.col("v")}, probs, most=most, accuracy=40 if most == 3 else 10_000)
    for name, data in (("a", values), ("b", -values)):
        series = pd.Series(data, dtype=float)
        percent = series.rank(pct=True)
        for p in probs:
            assert found[name].quantile(p) == (pytest.approx(series.quantile(p), rel=1e-12, abs=1e-12) if len(data) else None)
            able = series[percent <= p]
            assert found[name].percent_cut(p) == (able.max() if len(able) else None), (name, p)


def test_quantiles_exchange_no_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("v"))
    plan = R.attach(df, R.exact_quantiles(df, {"q": (F.col("v"), 0.9)}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_few_values_beside_many_bring_few_rows_to_the_driver(spark, monkeypatch):
    """A bracket of one frequent value is enough, and widening it is no reason to widen those of other metrics."""
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("many"), (F.col("id") % 5).alias("few"))
    collect, sizes = type(df).collect, []

    def counted(self):
        found = collect(self)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(type(df), "collect", counted)
    found = R.select_ranks(df, {"many": F.col("many"), "few": F.col("few")}, (0.2, 0.5, 0.8))
    assert sum(sizes) < 1000
    assert [found["few"].quantile(p) for p in (0.2, 0.5, 0.8)] == pytest.approx([0.8, 2.0, 3.2])
    assert [found["few"].percent_cut(p) for p in (0.2, 0.5, 0.8)] == [0.0, 1.0, 3.0]
    assert found["many"].quantile(0.5) == 29_999.5
    assert found["many"].percent_cut(0.2) == 11_999.0
