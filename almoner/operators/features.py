"""Account features, donor propensity models and prospect lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.functions.predicates import op_not_blank
from almoner.functions.scalars import days_since
from almoner.operators.cluster import fill_medians
from almoner.operators.ranks import attach, global_rank
from almoner.session import materialize

# Column-name patterns per category.
COLUMN_PATTERNS = {
    "donation_amount": (r"donation.*amount", r"giving", r"gift", r"contributed"),
    "donation_count": (r"donation.*count", r"number.*donation", r"gift.*count"),
    "phone": (r"phone", r"mobile", r"cell"),
    "address": (r"address", r"street", r"city", r"state", r"zip", r"postal", r"country"),
    "email": (r"email",),
    "date": (r"date", r"time", r"created", r"modified", r"updated"),
    "event": (r"event", r"registration", r"attendance"),
    "membership": (r"membership", r"member"),
    "activity": (r"activity", r"volunteer", r"engagement"),
}
# Parts of names that has_flags leaves out.
FLAG_EXCLUDED = ("is_", "has_", "engagement", "account_age", "days_since", "contact_", "account_id")

Columns = Mapping[str, Sequence[str]]


def discover_columns(names: Sequence[str], patterns=COLUMN_PATTERNS) -> dict[str, list[str]]:
    """Columns per category by name, in schema order."""
    return {
        kind: [n for n in names if any(re.search(p, n, re.IGNORECASE) for p in group)]
        for kind, group in patterns.items()
    }


def discovered_fill(df: DataFrame, patterns=COLUMN_PATTERNS) -> DataFrame:
    """One row per category and column found for it, with the rows that hold a value; one pass over the table."""
    found = [(kind, name) for kind, names in discover_columns(df.columns, patterns).items() for name in names]
    if not found:
        return df.sparkSession.createDataFrame([], "kind string, column string, filled bigint")
    counts = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("column"), F.count(F.col(f"`{name}`")).alias("filled"))
        for kind, name in found
    ]
    return df.agg(F.array(*counts).alias("s")).select(F.inline("s"))


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def targets(accounts: DataFrame, cols: Columns) -> DataFrame:
    """Lifetime amount, gift count, is_donor and is_major_donor (1000 or more)."""
    amounts, counts = cols.get("donation_amount", ()), cols.get("donation_count", ())
    plain = [c for c in amounts if c not in counts]
    zero = F.lit(0.0)
    number = lambda c: F.col(c).cast("string").try_cast("double")
    amount = F.coalesce(number(plain[0]), zero) if plain else zero
    count = F.coalesce(number(counts[0]), zero) if counts else zero
    return accounts.withColumns(
        {
            "lifetime_donation_amount": amount,
            "donation_count": count,
            "is_donor": _flag((amount > 0) | (count > 0)),
            "is_major_donor": _flag(amount >= 1000),
        }
    )


def contact_features(accounts: DataFrame, cols: Columns) -> DataFrame:
    """has_email, has_phone, has_address and the mean of those whose columns exist."""
    parts: dict[str, Column] = {}
    for kind in ("email", "phone"):
        if cols.get(kind):
            parts[f"has_{kind}"] = _flag(op_not_blank(F.col(cols[kind][0])))
    places = [c for c in cols.get("address", ()) if re.search("city|state|country", c, re.IGNORECASE)]
    if places:
        filled = reduce(Column.__or__, [op_not_blank(F.col(c)) for c in places])
        parts["has_address"] = _flag(filled)
    total = reduce(Column.__add__, parts.values(), F.lit(0)) if parts else F.lit(0)
    every = {f"has_{k}": parts.get(f"has_{k}", F.lit(0)) for k in ("email", "phone", "address")}
    return accounts.withColumns(
        {**every, "contact_completeness": total.cast("double") / max(len(parts), 1)}
    )


def age_features(accounts: DataFrame, cols: Columns, as_of: datetime) -> DataFrame:
    """Account age and days since the last change; a missing column gives 365 days."""
    dates = cols.get("date", ())
    created = next((c for c in dates if "creat" in c.lower()), None)
    changed = next((c for c in dates if "modif" in c.lower()), None)
    age = days_since(F.col(created), as_of) if created else F.lit(365)
    idle = days_since(F.col(changed), as_of) if changed else F.lit(365)
    return accounts.withColumns(
        {
            "account_age_days": age,
            "account_age_years": age / 365.25 if created else F.lit(1.0),
            "days_since_last_activity": idle,
            "has_recent_activity": _flag(idle <= 180) if changed else F.lit(0),
        }
    )


def engagement_flags(accounts: DataFrame, cols: Columns) -> DataFrame:
    """1 when any numeric column of the category is above 0."""
    flags = {}
    for kind in ("event", "membership", "activity"):
        tests = [
            F.coalesce(F.col(c).cast("string").try_cast("double") > 0, F.lit(False))
            for c in cols.get(kind, ())
        ]
        flags[f"{kind}_engagement"] = _flag(reduce(Column.__or__, tests)) if tests else F.lit(0)
    return accounts.withColumns(flags)


# Parts of the engagement score.
ENGAGEMENT_PARTS = (
    "contact_completeness",
    "has_recent_activity",
    "event_engagement",
    "membership_engagement",
    "activity_engagement",
)


def varying(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row telling which columns hold more than one value, i.e. have a variance above 0."""
    differs = lambda c: F.coalesce(F.max(c) > F.min(c), F.lit(False)).alias(c)
    return df.agg(*[differs(c) for c in columns])


def engagement_score(accounts: DataFrame) -> DataFrame:
    """Mean of the parts that vary over all accounts, else contact completeness; high from 0.6.

    Only the columns of the parts are read for the variances.
    """
    parts = [c for c in ENGAGEMENT_PARTS if c in accounts.columns]
    held = attach(accounts, varying(accounts.select(*parts), parts), "__v")
    used = [F.col("__v")[c].cast("double") for c in parts]
    total = reduce(Column.__add__, [F.col(c) * u for c, u in zip(parts, used)])
    count = reduce(Column.__add__, used)
    score = F.when(count > 0, F.try_divide(total, count)).otherwise(F.col("contact_completeness"))
    return (
        held.withColumn("engagement_score", score)
        .withColumn("high_engagement", _flag(F.col("engagement_score") >= 0.6))
        .drop("__v")
    )


def capacity_flag(accounts: DataFrame) -> DataFrame:
    """1 for companies and for membership fees above 500."""
    tests = []
    if "is_company" in accounts.columns:
        tests.append(F.coalesce(F.col("is_company") == 1, F.lit(False)))
    if "total_membership_fees" in accounts.columns:
        tests.append(F.coalesce(F.col("total_membership_fees") > 500, F.lit(False)))
    flag = _flag(reduce(Column.__or__, tests)) if tests else F.lit(0)
    return accounts.withColumn("potential_high_capacity", flag)


def has_flags(accounts: DataFrame, n: int | None = None) -> DataFrame:
    """has_<column> for all numeric columns that vary, or the first n.

    Which columns vary decides the output columns, so one aggregated row is read at plan time.
    """
    numeric = [
        f.name
        for f in accounts.schema.fields
        if isinstance(f.dataType, T.NumericType) and not any(p in f.name for p in FLAG_EXCLUDED)
    ]
    if not numeric:
        return accounts
    facts = varying(accounts, numeric).first()
    chosen = [c for c in numeric if facts[c]][:n]
    name = lambda c: "has_" + c.lower().replace(" ", "_").replace("/", "_")
    return accounts.withColumns({name(c): _flag(F.col(c) > 0) for c in chosen})


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.3, seed: int = 42
) -> DataFrame:
    """Add is_test: exactly the given share of each class, rounded, in hash order."""
    order = [F.asc(label), F.xxhash64(F.lit(seed), F.col(key)).asc(), F.asc(key)]
    ranked = global_rank(df, order, "__r")
    spans = ranked.groupBy(label).agg(F.count(F.lit(1)).alias("__n"), F.min("__r").alias("__first"))
    # one row per class
    return (
        ranked.join(F.broadcast(spans), label)
        .withColumn("is_test", F.col("__r") - F.col("__first") < F.round(F.col("__n") * test_share))
        .drop("__r", "__n", "__first")
    )


class PropensityResult:
    """Fitted models with their test AUC, the best one, and what scoring needs."""

    def __init__(self, models, aucs, features, prepared, scaler):
        self.models = models
        self.aucs = aucs
        self.features = features
        self.prepared = prepared
        self.scaler = scaler
        self.best = max(aucs, key=aucs.get)

    def importances(self) -> list[tuple[str, float]]:
        model = self.models[self.best]
        values = (
            [abs(x) for x in model.coefficients.toArray()]
            if self.best == "logistic_regression"
            else list(model.featureImportances.toArray())
        )
        return sorted(zip(self.features, map(float, values)), key=lambda p: (-p[1], p[0]))


def _passes_tasks(rows: int, cores: int) -> int:
    """Tasks of a pass that is repeated for every tree level or step: two per core, or one per 100,000 rows if these are more."""
    return max(2 * cores, -(-rows // 100_000))


def fit_propensity(
    df: DataFrame, features: Sequence[str], key: str = "account_id", label: str = "is_donor",
    seed: int = 42, trees: int = 100, rounds: int = 100,
) -> PropensityResult:
    """Random forest, boosted trees and logistic regression; the best test AUC wins.

    Nulls become medians and class weights are balanced, except for boosted trees.
    """
    used = [c for c in features if c in df.columns]
    split = stratified_split(df.select(key, label, *used), key, label, seed=seed)
    filled = fill_medians(split, used)
    vectors = VectorAssembler(inputCols=used, outputCol="x").transform(filled)
    train_raw = vectors.where(~F.col("is_test"))
    scaler = StandardScaler(inputCol="x", outputCol="xs", withMean=True).fit(train_raw)
    classes = train_raw.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = train_raw.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    weighted = (
        scaler.transform(vectors)
        .join(F.broadcast(classes), label)
        .withColumn("weight", F.lit(float(total)) / (F.col("__n") * 2))
    )
    prepared = materialize(weighted.drop("__n").withColumn(label, F.col(label).cast("double")))
    train, test = prepared.where(~F.col("is_test")), prepared.where("is_test")
    makers = {
        "random_forest": RandomForestClassifier(
            featuresCol="x", labelCol=label, weightCol="weight", numTrees=trees, seed=seed
        ),
        "gradient_boosting": GBTClassifier(
            featuresCol="x", labelCol=label, maxIter=rounds, maxDepth=3, seed=seed
        ),
        "logistic_regression": LogisticRegression(
            featuresCol="xs", labelCol=label, weightCol="weight", maxIter=1000
        ),
    }
    area = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    # bagging draws by partition and so keeps the frame's own; the others go through the rows hundreds of times, in few tasks
    few = train.coalesce(_passes_tasks(total, df.sparkSession.sparkContext.defaultParallelism))
    models = {name: maker.fit(train if name == "random_forest" else few) for name, maker in makers.items()}
    aucs = {name: area.evaluate(model.transform(test)) for name, model in models.items()}
    return PropensityResult(models, aucs, used, prepared, scaler)


def score_bands(scored: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    return scored.withColumns(
        {
            "high_propensity": _flag(s > 0.7),
            "score_band": F.when(s > 0.7, "High").when(s > 0.5, "Medium").otherwise("Low"),
        }
    )


def score_all(result: PropensityResult, key: str = "account_id") -> DataFrame:
    """Every account's score from the best model, with high flag and band."""
    scored = result.models[result.best].transform(result.prepared)
    return score_bands(scored.select(key, vector_to_array("probability")[1].alias("score")))


def prospect_category(df: DataFrame) -> Column:
    """Comma list of what an account already is, else General Prospect."""
    marks = {
        "has_active_membership": "Member",
        "is_volunteer": "Volunteer",
        "attends_events": "Event Attendee",
        "is_company": "Corporate",
        "potential_high_capacity": "High Capacity",
    }
    found = F.concat_ws(
        ", ", *[F.when(F.col(c) == 1, F.lit(label)) for c, label in marks.items() if c in df.columns]
    )
    return F.when(found == "", "General Prospect").otherwise(found)


def suggested_ask(df: DataFrame, score: str = "score") -> Column:
    """Base ask by profile, half as much again above a score of 0.8, cut to whole units."""
    col = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0)
    fees = col("total_membership_fees").cast("double")
    base = (
        F.when(col("is_company") == 1, 250.0)
        .when(fees > 100, F.greatest(F.lit(50.0), fees * 0.5))
        .when(col("has_active_membership") == 1, 50.0)
        .when(col("is_volunteer") == 1, 35.0)
        .otherwise(25.0)
    )
    return F.floor(F.when(F.col(score) > 0.8, base * 1.5).otherwise(base))


def top_prospects(scored: DataFrame, n: int = 50, score: str = "score") -> DataFrame:
    """The n best-scored accounts that have not given, with category and suggested ask."""
    others = scored.where(F.col("is_donor") == 0)
    best = others.orderBy(F.desc(score), F.asc("account_id")).limit(n)
    return best.withColumn("prospect_category", prospect_category(best)).withColumn(
        "suggested_ask", suggested_ask(best, score)
    )
