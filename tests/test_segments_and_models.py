"""Segments, clusters, models, access and sources on small tables."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from almoner.operators import access as G
from almoner.operators import aggregates as A
from almoner.operators import cluster as K
from almoner.operators import features as E
from almoner.operators import lists as L
from almoner.operators import paging as P
from almoner.operators import search as Q
from almoner.operators import segments as R
from almoner.operators import series as W
from almoner.sources import resources, shaping, sinks


def gifts(spark, data):
    df = spark.createDataFrame(data, "donation_id int, account_id int, amount double, date string")
    return df.withColumn("amount", F.col("amount").cast("decimal(18,2)")).withColumn("date", F.col("date").cast("timestamp_ntz"))


def test_single_gift_has_no_deviation_and_no_tenure_label(spark):
    rfm = R.rfm_metrics(gifts(spark, [(1, 1, 50.0, "2001-01-01"), (2, 2, 10.0, "2000-01-01"), (3, 2, 20.0, "2001-01-01")]), datetime(2001, 1, 31))
    got = {r["account_id"]: r for r in R.tenure_category(rfm).collect()}
    assert got[1]["donation_std"] == 0.0 and got[1]["tenure_category"] is None
    assert got[2]["tenure_days"] == 366 and got[2]["tenure_category"] == "1-2 years"
    assert got[1]["recency_days"] == 30


def test_retention_uses_observed_years(spark, rows):
    data = gifts(spark, [(1, 1, 5.0, "1999-03-01"), (2, 1, 5.0, "2001-03-01"), (3, 2, 5.0, "1999-05-01"), (4, 3, 5.0, "2001-01-01")])
    assert rows(W.annual_retention(data)) == [(1999, 2001, 2, 1, 50.0)]
    pair = W.year_pair(data, datetime(2001, 6, 1)).first()
    assert (pair["donors_last_year"], pair["retention_rate"], pair["new_donors"]) == (0, 0.0, 2)
    growth = W.yoy(data, datetime(2001, 6, 1)).where("account_id = 1").first()
    assert growth["yoy_growth"] == 0.0


def test_recency_and_expiry_edges(spark, rows):
    days = spark.createDataFrame([(d,) for d in (0, 29, 30, 90, 365, 1095)], "d int")
    labels = [r[0] for r in days.select(A.recency_bucket(F.col("d"))).collect()]
    assert labels == ["0-30 days", "0-30 days", "30-90 days", "90-180 days", "1-2 years", "3+ years"]
    left = spark.createDataFrame([(d,) for d in (-1, 0, 1, 30, 31)], "d int")
    labels = [r[0] for r in left.select(A.expiry_category(F.col("d"))).collect()]
    assert labels == ["Expired", "Expired", "0-30 days", "0-30 days", "31-90 days"]


def test_key_order(spark):
    df = spark.createDataFrame([("b",), ("10",), ("A",), ("2",)], "k string")
    assert [r["k"] for r in P.order_by_key(df, "k").collect()] == ["2", "10", "A", "b"]


def test_paging_limits(spark):
    df = spark.range(1200).withColumnRenamed("id", "k")
    seen, last = [], None
    while True:
        page = [r["k"] for r in P.page_after(df, "k", last, 500).collect()]
        if not page:
            break
        seen, last = seen + page, page[-1]
    assert seen == list(range(1200))
    assert sorted(r["k"] for r in P.page(df, "k", 2, 500).collect()) == list(range(1000, 1200))
    for size in (0, 501):
        with pytest.raises(ValueError):
            P.page(df, "k", 0, size)


def test_requests(spark):
    request = {"searchFields": [{"field": "Amount", "operator": "EQUAL", "value": 5}], "outputFields": ["12", "Fund"]}
    assert Q.rename_request(request)["searchFields"][0]["field"] == "amount"
    plain = Q.normalise_literals(request)
    assert plain["searchFields"][0]["value"] == "5" and plain["outputFields"] == [12, "Fund"]
    named = Q.resolve_custom_names({"searchFields": [{"field": "Shoe", "operator": "BLANK"}]}, {"Shoe": "9"}, ["amount"])
    assert named["searchFields"][0]["field"] == "9"
    with pytest.raises(ValueError):
        L.list_accounts(spark.range(1), "PERSON")


def test_kmeans_finds_planted_groups_and_is_stable(spark):
    rng = random.Random(7)
    data = [
        (i, 100 * (i % 3) + rng.random(), 10 * (i % 3) + rng.random(), 1000.0 * (i % 3) + rng.random(), None if i == 5 else 50.0 * (i % 3), 10.0)
        for i in range(90)
    ]
    df = spark.createDataFrame(data, "account_id int, recency_days double, frequency double, total_donated double, avg_donation double, tenure_days double")
    first = K.kmeans_donors(df, k=3, starts=3)
    groups = {}
    for r in first.collect():
        groups.setdefault(r["account_id"] % 3, set()).add(r["cluster"])
    assert sorted(len(g) for g in groups.values()) == [1, 1, 1]
    again = {r["account_id"]: r["cluster"] for r in K.kmeans_donors(df, k=3, starts=3).collect()}
    assert again == {r["account_id"]: r["cluster"] for r in first.collect()}
    profile = K.cluster_profile(first).collect()
    assert len(profile) == 3 and sum(r["donors"] for r in profile) == 90
    assert sum(r["revenue_share"] for r in profile) == pytest.approx(100.0)


def test_propensity_learns_a_planted_signal(spark):
    rng = random.Random(8)
    data = []
    for i in range(400):
        signal = rng.random()
        data.append((i, int(signal + rng.gauss(0, 0.15) > 0.7), signal, rng.random() if i % 7 else None))
    df = spark.createDataFrame(data, "account_id int, is_donor int, signal double, noise double")
    result = E.fit_propensity(df, ["signal", "noise", "absent"], trees=10, rounds=5)
    assert result.features == ["signal", "noise"]
    assert all(a > 0.8 for a in result.aucs.values())
    assert result.importances()[0][0] == "signal"
    scored = E.score_all(result)
    assert scored.count() == 400
    assert scored.where("score < 0 or score > 1").isEmpty()
    split = E.stratified_split(df, "account_id", "is_donor").groupBy("is_donor").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n"))
    for r in split.collect():
        assert r["t"] == round(r["n"] * 0.3)


def test_ask_and_category(spark):
    df = spark.createDataFrame(
        [(1, 0, 1, 0.9, 0.0, 0, 0), (2, 0, 0, 0.5, 150.0, 1, 0), (3, 0, 0, 0.5, 90.0, 1, 0), (4, 0, 0, 0.81, 0.0, 0, 1), (5, 0, 0, 0.1, 0.0, 0, 0), (6, 1, 0, 1.0, 0.0, 0, 0)],
        "account_id int, is_donor int, is_company int, score double, total_membership_fees double, has_active_membership int, is_volunteer int",
    )
    got = {r["account_id"]: (r["suggested_ask"], r["prospect_category"]) for r in E.top_prospects(df, 10).collect()}
    assert got == {1: (375, "Corporate"), 2: (75, "Member"), 3: (50, "Member"), 4: (52, "Volunteer"), 5: (25, "General Prospect")}


def test_permissions(spark):
    matrix = G.role_matrix(spark)
    users = spark.createDataFrame([(1, "admin"), (2, "viewer"), (3, "fundraiser")], "user_id int, role string")
    own = spark.createDataFrame([(2, "events", "write"), (3, "donations", None)], "user_id int, resource string, permission string")
    perms = G.effective_permissions(users, matrix, own)
    G.require(perms, 1, "payments", "delete")
    G.require(perms, 2, "events", "write")
    for user, resource, permission in ((2, "events", "read"), (3, "donations", "read"), (None, "events", "read"), (9, "events", "read")):
        with pytest.raises(PermissionError):
            G.require(perms, user, resource, permission)
    assert matrix.select("role", "resource").distinct().count() == 120


def test_rules(spark, rows):
    kpi = spark.createDataFrame([(45.0, 3.0, 30.0)], "retention_rate double, avg_gifts double, opportunity_rate double")
    assert rows(R.apply_rules(kpi, R.rule_table(kpi)), "area") == [("Donor Retention",), ("Opportunity Engagement",)]


def test_sources(spark, rows, tmp_path):
    assert resources.primary_key("donations") == "donationId" and resources.primary_key("campaigns") == "id"
    path = str(tmp_path / "accounts")
    data = spark.createDataFrame([("1", "A")], "accountId string, firstName string")
    data.write.json(path)
    df = resources.read_resource(spark, path, "accounts", fmt="json")
    assert df.schema == resources.schema_of("accounts")
    assert rows(df, "accountId", "email") == [("1", None)]
    with pytest.raises(ValueError):
        resources.read_resource(spark, path, "webhooks", fmt="json")
    pages = spark.createDataFrame([('{"accounts":[{"id":1}]}',), ('[{"id":2}]',), ('{"data":[{"id":3}]}',), ("{}",)], "body string")
    assert rows(shaping.unwrap_pages(pages, "accounts", "struct<id:int>")) == [(1,), (2,), (3,)]
    out = str(tmp_path / "prospects")
    sinks.export_prospects(spark.createDataFrame([(1, "x", 9)], "account_id int, email string, other int"), out)
    assert rows(spark.read.option("header", True).csv(out)) == [("1", "x")]


def test_repeated_passes_use_few_tasks(spark, monkeypatch):
    """Boosting and regression go through the rows hundreds of times; bagging draws by partition and keeps the frame's own."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

    parts = {}
    for maker in (GBTClassifier, LogisticRegression, RandomForestClassifier):
        def fit(self, dataset, params=None, old=maker.fit, name=maker.__name__):
            parts[name] = dataset.rdd.getNumPartitions()
            return old(self, dataset, params)

        monkeypatch.setattr(maker, "fit", fit)
    set_to = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(400).selectExpr("id AS account_id", "cast(id % 3 = 0 AS int) AS is_donor", "cast(id % 7 AS double) AS a")
        result = E.fit_propensity(df, ["a"], trees=2, rounds=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", set_to)
    few = 2 * spark.sparkContext.defaultParallelism
    assert parts["GBTClassifier"] == parts["LogisticRegression"] == few < parts["RandomForestClassifier"]
    assert set(result.aucs) == {"random_forest", "gradient_boosting", "logistic_regression"}


def test_passes_get_more_tasks_with_more_rows():
    assert E._passes_tasks(1_000, 12) == 24
    assert E._passes_tasks(4_000_001, 12) == 41
