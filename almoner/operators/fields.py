"""Edits of custom-field values: set, add and remove options, append, clear, ordered batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.scalars import format_multivalue, parse_multivalue
from almoner.operators.aggregates import rows
from almoner.operators.quality import FieldMeta, error_free
from almoner.operators.ranks import attach
from almoner.session import materialize

MULTI_TYPES = ("Checkbox", "MultiSelect")
# An option with more than one in HOT_SHARE of all edits is spread over SALTS tasks.
HOT_SHARE = 1000
SALTS = 64


def add_option(c: Column, option: Column | str) -> Column:
    """List with the option at the end unless already present."""
    value = F.lit(option) if isinstance(option, str) else option
    values = F.coalesce(c, F.array().cast("array<string>"))
    return F.when(F.array_contains(values, value), values).otherwise(F.array_append(values, value))


def remove_option(c: Column, option: Column | str) -> Column:
    """List without the first occurrence of the option."""
    value = F.lit(option) if isinstance(option, str) else option
    values = F.coalesce(c, F.array().cast("array<string>"))
    at = F.array_position(values, value).cast("int")
    cut = F.concat(F.slice(values, F.lit(1), at - 1), F.slice(values, at + 1, F.size(values)))
    return F.when(at > 0, cut).otherwise(values)


def append_text(c: Column, text: Column | str, sep: str = " ") -> Column:
    """Text with more appended; an empty value becomes just the new text."""
    value = F.lit(text) if isinstance(text, str) else text
    return F.when(F.coalesce(c, F.lit("")) == "", value).otherwise(F.concat(c, F.lit(sep), value))


def clear_field(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(df.schema[name].dataType))


def _by_name(fields: Sequence[FieldMeta]) -> dict[str, FieldMeta]:
    return {m.name: m for m in fields}


def update_valid(fields: Sequence[FieldMeta], name: str = "field", value: str = "value") -> Column:
    """Whether a (field, value) row passes its field's rules; unknown fields do not."""
    out = F.lit(False)
    for meta in fields:
        out = F.when(F.col(name) == meta.name, error_free(F.col(value), meta)).otherwise(out)
    return out


def set_fields(
    df: DataFrame, updates: DataFrame, fields: Sequence[FieldMeta], key: str, validate: bool = True
) -> DataFrame:
    """Apply (key, field, value, seq) updates; invalid ones leave the value alone, the last valid wins."""
    kept = updates.where(update_valid(fields)) if validate else updates
    names = [m.name for m in fields if m.name in df.columns]
    newest = kept.groupBy(key).agg(
        *[
            F.max_by(F.struct("value"), F.when(F.col("field") == n, F.col("seq"))).alias(f"__new_{n}")
            for n in names
        ]
    )
    joined = df.join(newest, key, "left")
    changed = {
        n: F.when(F.col(f"__new_{n}").isNotNull(), F.col(f"__new_{n}")["value"]).otherwise(F.col(n))
        for n in names
    }
    return joined.withColumns(changed).select(*df.columns)


def update_outcomes(updates: DataFrame, fields: Sequence[FieldMeta]) -> DataFrame:
    return updates.agg(
        F.count_if(update_valid(fields)).alias("successful"),
        F.count_if(~update_valid(fields)).alias("failed"),
    )


def op_allowed(fields: Sequence[FieldMeta]) -> Column:
    """Whether a batch operation suits its field: replace anywhere, add and remove on lists, append on text."""
    op, value = F.col("op"), F.col("value")
    many = [m for m in fields if m.display_type in MULTI_TYPES]
    is_many = F.col("field").isin(*[m.name for m in many]) if many else F.lit(False)
    fits = (
        F.when(op == "replace", F.lit(True))
        .when(op.isin("add", "remove"), is_many)
        .when(op == "append", ~is_many)
        .otherwise(False)
    )
    checked = F.when(op.isin("replace", "add"), update_valid(fields)).otherwise(
        F.col("field").isin(*[m.name for m in fields])
    )
    return F.coalesce(value.isNotNull() & fits & checked, F.lit(False))


def _same(names: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{prefix}{n}")) for n in names])


def _after_resets(edits: DataFrame, marks: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Edits that follow their cell's last replace, with the option's last removal.

    An option (or, for texts, a cell) that holds more than one in HOT_SHARE of all edits is spread over SALTS
    copies of its mark. There are fewer than HOT_SHARE of these at any size, so they are broadcast.
    """
    total = marks.agg(F.sum("n").alias("edits"))
    is_hot = F.col("n") * HOT_SHARE > F.col("__total")["edits"]
    flagged = attach(marks, total, "__total").withColumn("hot", is_hot).drop("__total", "n")
    hot = flagged.where("hot").select(*[F.col(c).alias(f"__h_{c}") for c in cell], F.lit(True).alias("__hot"))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = edits.join(F.broadcast(hot), _same(cell, "__h_"), "left").withColumn("__salt", salt)
    copies = flagged.select(
        *[F.col(c).alias(f"__m_{c}") for c in (*cell, "last", "reset")],
        F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), SALTS - 1).otherwise(0))).alias("__m___salt"),
    )
    joined = salted.join(copies, _same([*cell, "__salt"], "__m_"))
    later = F.col("__m_reset").isNull() | (F.col("seq") > F.col("__m_reset")["seq"])
    return joined.where(later).select(*edits.columns, F.col("__m_last").alias("last"))


def _text_results(edits: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Appended text per cell in seq order. It is as long as the value that the cell gets."""
    live = _after_resets(edits, marks, [key, "field", "option"])
    return live.groupBy(key, "field").agg(F.expr("listagg(value, ' ') WITHIN GROUP (ORDER BY seq)").alias("appended"))


def _list_results(edits: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Per cell, one entry per edited option: how many removals there were, and the first add after the last one."""
    cell = [key, "field", "option"]
    after = F.col("last").isNull() | (F.col("seq") > F.col("last"))
    per_option = (
        _after_resets(edits, marks, cell)
        .groupBy(*cell)
        .agg(
            F.count_if(F.col("op") == "remove").alias("removals"),
            F.min(F.when((F.col("op") == "add") & after, F.col("seq"))).alias("at"),
        )
    )
    return per_option.groupBy(key, "field").agg(
        F.collect_list(F.struct("option", "removals", "at")).alias("options")
    )


def _apply_options(start: Column, options: Column) -> Column:
    """Surviving occurrences of the starting list, then added options in the order they were added."""
    values = parse_multivalue(start)
    removals = F.map_from_entries(F.transform(options, lambda o: F.struct(o["option"], o["removals"])))
    count = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    survivors = F.filter(
        values,
        lambda v, i: count(F.slice(values, F.lit(1), i + 1), v)
        > F.coalesce(F.try_element_at(removals, v), F.lit(0)),
    )
    fresh = F.filter(
        options, lambda o: o["at"].isNotNull() & (o["removals"] >= count(values, o["option"]))
    )
    ordered = F.array_sort(F.transform(fresh, lambda o: F.struct(o["at"].alias("at"), o["option"].alias("option"))))
    return format_multivalue(F.concat(survivors, F.transform(ordered, lambda o: o["option"])))


def batch_update(df: DataFrame, ops: DataFrame, fields: Sequence[FieldMeta], key: str) -> DataFrame:
    """Apply (key, field, op, value, seq) edits in seq order; edits that do not fit change nothing.

    `seq` is unique and of any type with an order. Only edits after a cell's last replace count. A first
    aggregate marks the last replace per cell and the last removal per option, a second one sums up what follows the
    marks, so no edit is gathered into a list. The marks are materialized: one row per cell and option.
    """
    meta = _by_name(fields)
    names = [n for n in meta if n in df.columns]
    many = [n for n in names if meta[n].display_type in MULTI_TYPES]
    is_many = F.col("field").isin(*many) if many else F.lit(False)
    option = F.when(F.col("op").isin("add", "remove"), F.col("value"))
    edits = ops.where(op_allowed(fields) & F.col("field").isin(*names)).select(
        key, "field", option.alias("option"), "op", "value", "seq"
    )
    of_kind = lambda kind: F.when(F.col("op") == kind, F.col("seq"))
    marks = materialize(
        edits.groupBy(key, "field", "option").agg(
            rows().alias("n"),
            F.max(of_kind("remove")).alias("last"),
            F.max_by(F.struct("seq", "value"), of_kind("replace")).alias("reset"),
        )
    )
    resets = marks.where(F.col("reset").isNotNull()).select(key, "field", "reset")
    bounds = marks.drop("reset").join(resets, [key, "field"], "left")
    others = edits.where(F.col("op") != "replace")
    texts = _text_results(others.where(~is_many), bounds.where(~is_many), key)
    lists = _list_results(others.where(is_many), bounds.where(is_many & F.col("option").isNotNull()), key)
    parts = resets.unionByName(texts, allowMissingColumns=True).unionByName(lists, allowMissingColumns=True)

    def of_field(n: str) -> Column:
        # at most one row per cell holds each part
        mine = [F.max(F.when(F.col("field") == n, F.col(c))).alias(c) for c in ("reset", "appended", "options")]
        return F.when(F.count_if(F.col("field") == n) > 0, F.struct(*mine)).alias(f"__e_{n}")

    results = parts.groupBy(key).agg(*[of_field(n) for n in names])
    joined = df.join(results, key, "left")
    changed = {}
    for n in names:
        edit = F.col(f"__e_{n}")
        start = F.when(edit["reset"].isNotNull(), edit["reset"]["value"]).otherwise(F.col(n))
        if n in many:
            value = F.when(edit["options"].isNull(), start).otherwise(
                _apply_options(start, edit["options"])
            )
        else:
            value = F.when(edit["appended"].isNull(), start).otherwise(
                append_text(start, edit["appended"])
            )
        changed[n] = F.when(edit.isNull(), F.col(n)).otherwise(value)
    return joined.withColumns(changed).select(*df.columns)


def batch_outcomes(ops: DataFrame, fields: Sequence[FieldMeta]) -> DataFrame:
    """Successful and failed edits per kind of operation."""
    return ops.groupBy("op").agg(
        rows().alias("total"),
        F.count_if(op_allowed(fields)).alias("successful"),
        F.count_if(~op_allowed(fields)).alias("failed"),
    )
