"""Moving values between custom fields: plans, conflicts, dry runs and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.functions.scalars import format_multivalue, parse_multivalue
from almoner.operators.aggregates import rows
from almoner.operators.fields import MULTI_TYPES, add_option
from almoner.operators.quality import FieldMeta, error_free
from almoner.operators.search import where_all

STRATEGIES = ("REPLACE", "COPY_IF_EMPTY", "ADD_OPTION", "MERGE", "TRANSFORM")
STATUS = "migration_status"


@dataclass(frozen=True)
class FieldMapping:
    """Source field to target field with a strategy and an optional Column -> Column transform."""

    source: str
    target: str
    strategy: str = "REPLACE"
    transform: Callable[[Column], Column] | None = None
    validate: bool = True

    @property
    def label(self) -> str:
        return f"{self.source} -> {self.target}"


def plan_from_mapping(config: Mapping[str, Any]) -> list[FieldMapping]:
    """Mappings from a dictionary: TODO is skipped, an option becomes a constant ADD_OPTION."""
    plan = []
    for source, entry in config.items():
        if entry == "TODO":
            continue
        if "option" in entry:
            option = entry["option"]
            plan.append(
                FieldMapping(source, entry["field"], "ADD_OPTION", lambda c, o=option: F.lit(o))
            )
        else:
            plan.append(FieldMapping(source, entry["field"], "COPY_IF_EMPTY"))
    return plan


def _is_list(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def _empty(c: Column, is_list: bool) -> Column:
    return c.isNull() | ((F.size(c) == 0) if is_list else (c == ""))


def _step(
    df: DataFrame, m: FieldMapping, meta: Mapping[str, FieldMeta], dry_run: bool
) -> tuple[Column, Column]:
    """New target value and status of one mapping."""
    source, target = F.col(m.source), F.col(m.target)
    value = m.transform(source) if m.transform else source
    list_source = _is_list(df, m.source) and m.transform is None
    list_target = _is_list(df, m.target)
    rules = meta.get(m.target)
    as_text = lambda c, is_list: format_multivalue(c) if is_list else c
    valid = error_free(as_text(value, list_source), rules) if m.validate else F.lit(True)
    ready = source.isNotNull() & valid
    empty = _empty(target, list_target)
    fitted = value
    if list_target and not list_source:
        fitted = parse_multivalue(value)
    elif list_source and not list_target:
        fitted = format_multivalue(value)
    if m.strategy == "REPLACE":
        new, fits = fitted, F.lit(True)
    elif m.strategy == "ADD_OPTION":
        current = target if list_target else parse_multivalue(target)
        added = add_option(current, value) if not list_source else current
        new, fits = (added if list_target else format_multivalue(added)), F.lit(not list_source)
    elif m.strategy == "COPY_IF_EMPTY":
        new, fits = F.when(empty, fitted).otherwise(target), F.lit(True)
    elif m.strategy == "MERGE":
        if list_target and list_source:
            merged = F.array_distinct(F.concat(target, value))
        elif not list_target and not list_source:
            merged = F.concat(target, F.lit(" "), value)
        else:
            merged = fitted
        new, fits = F.when(empty, fitted).otherwise(merged), F.lit(True)
    else:
        new, fits = target, F.lit(dry_run)
    if rules is not None and m.strategy != "COPY_IF_EMPTY":
        fits = fits & (F.lit(True) if dry_run else error_free(as_text(new, list_target), rules))
    done = ready & fits
    if dry_run:
        done = ready
    status = F.when(source.isNull(), "no_source").when(done, "success").otherwise("failed")
    return F.when(done, new).otherwise(target), status


def migrate(
    df: DataFrame,
    mappings: Sequence[FieldMapping],
    fields: Sequence[FieldMeta] = (),
    dry_run: bool = False,
) -> DataFrame:
    """Apply the mappings in order and add one status per mapping; a dry run changes no value.

    A missing source or an invalid value fails. TRANSFORM alone has no effect and fails.
    """
    for m in mappings:
        if m.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {m.strategy!r}")
    meta = {f.name: f for f in fields}
    out, statuses = df, []
    for i, m in enumerate(mappings):
        new, status = _step(out, m, meta, dry_run)
        out = out.withColumns({f"__s{i}": status} | ({} if dry_run else {m.target: new}))
        statuses.append(
            F.struct(F.lit(m.label).alias("mapping"), F.col(f"__s{i}").alias("status"))
        )
    return out.withColumn(STATUS, F.array(*statuses)).drop(*[f"__s{i}" for i in range(len(mappings))])


def migration_report(migrated: DataFrame) -> DataFrame:
    """Rows, successful and failed rows (a row fails when any mapping does); skipped stays 0."""
    ok = F.forall(F.col(STATUS), lambda s: s["status"] == "success")
    no_source = F.exists(F.col(STATUS), lambda s: s["status"] == "no_source")
    return migrated.agg(
        rows().alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.lit(0).alias("skipped"),
        F.count_if(no_source).alias("no_source"),
    )


def mapping_report(migrated: DataFrame) -> DataFrame:
    """Rows per mapping and status."""
    return (
        migrated.select(F.inline(STATUS)).groupBy("mapping", "status").agg(rows().alias("count"))
    )


def migration_conflicts(
    df: DataFrame, mappings: Sequence[FieldMapping], fields: Sequence[FieldMeta]
) -> DataFrame:
    """One row per conflict: missing fields, differing types, rows where REPLACE would overwrite."""
    meta = {f.name: f for f in fields}
    facts = []
    for m in mappings:
        s, t = meta.get(m.source), meta.get(m.target)
        if s is None:
            facts.append((m.label, "missing_source", m.source, None))
        if t is None:
            facts.append((m.label, "missing_target", m.target, None))
        if s and t and s.display_type != t.display_type:
            facts.append((m.label, "type_mismatch", f"{s.display_type} -> {t.display_type}", None))
            if s.display_type in ("OneLineText", "MultiLineText") and t.display_type in MULTI_TYPES:
                facts.append((m.label, "needs_text_parsing", m.label, None))
    schema = "mapping string, kind string, detail string, conflict_rows bigint"
    known = df.sparkSession.createDataFrame(facts, schema)
    replacing = [
        m for m in mappings if m.strategy == "REPLACE" and {m.source, m.target} <= set(df.columns)
    ]
    if not replacing:
        return known
    both = [
        F.struct(
            F.lit(m.label).alias("mapping"),
            F.lit("both_filled").alias("kind"),
            F.lit(None).cast("string").alias("detail"),
            F.count_if(
                ~_empty(F.col(m.source), _is_list(df, m.source))
                & ~_empty(F.col(m.target), _is_list(df, m.target))
            ).alias("conflict_rows"),
        )
        for m in replacing
    ]
    counted = df.agg(F.array(*both).alias("b")).select(F.inline("b"))
    return known.unionByName(counted.where(F.col("conflict_rows") > 0))


def lacking_option(df: DataFrame, field: str, option: str) -> DataFrame:
    return df.where(~F.array_contains(parse_multivalue(F.col(field)), option))


def bulk_add_option(df: DataFrame, field: str, option: str) -> DataFrame:
    """Rows that lacked the option, with it added."""
    added = add_option(parse_multivalue(F.col(field)), option)
    return lacking_option(df, field, option).withColumn(field, format_multivalue(added))


def _rules(fields: Sequence[FieldMeta]) -> tuple[list[FieldMeta], list[int]]:
    """Distinct validation rules, and the rule of every field: fields of one kind share one."""
    kinds = [replace(m, name="", id=None, data_type=None) for m in fields]
    distinct = list(dict.fromkeys(kinds))
    return distinct, [distinct.index(k) for k in kinds]


def _values_by_field(df: DataFrame, used: Sequence[FieldMeta], keep: Sequence[str] = ()) -> DataFrame:
    """One row per row and field: position, name, text, and per rule whether the text would pass it."""
    distinct, _ = _rules(used)
    text = F.array(*[F.col(f"`{m.name}`").cast("string") for m in used])
    names = F.array(*[F.lit(m.name) for m in used])
    long = df.select(*keep, F.posexplode(text).alias("at", "value"))
    valid = F.array(*[error_free(F.col("value"), r) for r in distinct])
    return long.withColumn("source", names[F.col("at")]).withColumn("valid", valid)


def all_pair_report(df: DataFrame, fields: Sequence[FieldMeta]) -> DataFrame:
    """Rows per ordered field pair and status of copying one into the other when it is empty.

    Values are checked against each distinct rule once and counted by (field, rule); pairs are put together from
    these counts and the list of fields, so neither the plan nor the rows grow with the number of pairs.
    """
    used = [m for m in fields if m.name in df.columns]
    distinct, rule_of = _rules(used)
    filled = F.col("value").isNotNull()
    counted = (
        _values_by_field(df, used)
        .groupBy("source")
        .agg(
            F.count_if(filled).alias("filled"),
            F.count_if(~filled).alias("skipped"),
            F.array(*[F.count_if(filled & F.col("valid")[i]) for i in range(len(distinct))]).alias("passed"),
        )
    )
    others = F.array(*[F.struct(F.lit(m.name).alias("target"), F.lit(r).alias("rule")) for m, r in zip(used, rule_of)])
    success = F.col("passed")[F.col("t.rule")]
    return (
        counted.withColumn("t", F.explode(others))
        .where(F.col("source") != F.col("t.target"))
        .select("source", "t.target", success.alias("success"), (F.col("filled") - success).alias("failed"), "skipped")
    )


def row_pair_report(df: DataFrame, fields: Sequence[FieldMeta], key: str) -> DataFrame:
    """Per row, source and target: status of a trial copy into an empty target, why, and both values.

    A missing source is skipped, an invalid one fails; a filled target is a success that copies nothing. The report
    has fields x (fields - 1) rows for each row of `df`, which is meant to be a selection; nothing is shuffled.
    """
    used = [m for m in fields if m.name in df.columns]
    _, rule_of = _rules(used)
    targets = F.array(
        *[
            F.struct(F.lit(m.name).alias("target"), F.lit(r).alias("rule"), F.lit(i).alias("at"))
            for i, (m, r) in enumerate(zip(used, rule_of))
        ]
    )
    texts = F.array(*[F.col(f"`{m.name}`").cast("string") for m in used])
    held = df.select(F.col(f"`{key}`").alias("__key"), *[F.col(f"`{m.name}`") for m in used]).withColumn("__all", texts)
    pairs = (
        _values_by_field(held, used, ["__key", "__all"])
        .withColumn("t", F.explode(targets))
        .where(F.col("at") != F.col("t.at"))
    )
    missing, passes = F.col("value").isNull(), F.col("valid")[F.col("t.rule")]
    return pairs.select(
        F.col("__key").alias(key),
        "source",
        "t.target",
        F.when(missing, "skipped").when(passes, "success").otherwise("failed").alias("status"),
        F.when(missing, "No source value").when(~passes, "Migration execution failed").alias("reason"),
        F.col("value").alias("source_value"),
        F.when(~missing, F.col("__all")[F.col("t.at")]).alias("target_value"),
    )


def row_pair_totals(df: DataFrame, fields: Sequence[FieldMeta], key: str) -> DataFrame:
    """Per row: pairs, successful, failed and skipped ones, without listing them."""
    used = [m for m in fields if m.name in df.columns]
    distinct, rule_of = _rules(used)
    held = df.select(F.col(f"`{key}`").alias("__key"), F.struct(*[F.col(f"`{m.name}`") for m in used]).alias("__row"))
    stamped = held.withColumn("__id", F.monotonically_increasing_id()).select("__key", "__id", "__row.*")
    own = F.array(*[F.lit(r) for r in rule_of])[F.col("at")]
    # targets per rule, without the source itself
    passed = sum(
        F.col("valid")[i].cast("int") * (F.lit(rule_of.count(i)) - (own == i).cast("int")) for i in range(len(distinct))
    )
    filled, others = F.col("value").isNotNull(), len(used) - 1
    return (
        _values_by_field(stamped, used, ["__key", "__id"])
        .groupBy("__id", "__key")
        .agg(
            F.lit(len(used) * others).cast("bigint").alias("total_mappings"),
            F.sum(F.when(filled, passed).otherwise(0)).alias("successful_mappings"),
            F.sum(F.when(filled, F.lit(others) - passed).otherwise(0)).alias("failed_mappings"),
            F.sum(F.when(filled, 0).otherwise(others)).alias("skipped_mappings"),
        )
        .withColumnRenamed("__key", key)
        .drop("__id")
    )


def resource_filter(df: DataFrame, wanted: Mapping[str, Any]) -> DataFrame:
    """Rows equal on every filter key; no safety cap."""
    return where_all(
        df, [{"field": k, "operator": "EQUAL", "value": v} for k, v in wanted.items()]
    )
