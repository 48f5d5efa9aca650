"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Every document gets a random key, the md5 of its id and a seed. A source's documents are taken in key
order until its budget is used up; a budget above the source's size starts further epochs. The keys are
uniform, so their first hex digits are range bounds that need no sampling: a (source, range) cell holds
about 1/4096 of its source, however large the source is. Sums per cell are combined before the shuffle,
running sums over at most 4096 cells give each cell's offset, and only rows of one cell are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: float = 3.0
) -> DataFrame:
    """(source, source_size, target) from one (source, source_size) row per source.

    Sources in code-point order, null last, weigh `weights` in turn. The total size is shared by weight; no
    target passes max_epochs times its source, and what is above goes to the others by weight. Sources
    are filled up in the order of limit per weight: those in front of the first source whose share of
    the rest stays within its limit get their limits, all others their share of the rest.
    The frame has one row per source, which is all that its unpartitioned windows see.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    limits = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("limit"),
    )
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    rest = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest_weight = weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shared = limits.withColumns({"share": rest / rest_weight, "place": F.row_number().over(filled)})
    open_ = F.col("share") * F.col("weight") <= F.col("limit")
    first = F.min(F.when(open_, F.struct("place", "share"))).over(everything)
    return shared.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("place") >= F.col("first.place"), F.col("weight") * F.col("first.share"))
        .otherwise(F.col("limit"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    max_epochs: float = 3.0,
    seed: str = "mix",
    digits: int = 3,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    `taken` counts words over all epochs: size times the whole epochs, plus, in the last and partial
    epoch, the words up to the source's budget, which is its target rounded down. Only the document that
    the budget ends in is taken in part, so the words taken from a source add up to the budget exactly.

    A null text has size 0; null sources are one source; null ids are ordered like the text ''. Repeated
    rows are documents of their own, told apart by size only, so rows that agree in id and size may
    exchange their places. An empty table gives an empty result. Other columns are ignored. With row_col, a column that
    is different in every row, it orders such rows and comes back with the result.
    """
    row = F.col(row_col).cast("string") if row_col else F.lit(None).cast("string")
    rows = docs.select(
        row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    ).withColumn("key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("cell", F.substring("key", 1, digits))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sizes = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    budget = F.floor("target").cast("long")
    plan = source_targets(sizes, weights, max_epochs).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"),
        }
    )
    plan = plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    earlier = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "source", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("offset")
    )
    facts = offsets.alias("o").join(plan.alias("p"), F.col("o.source").eqNullSafe(F.col("p.source"))).select(
        F.col("o.source").alias("cell_source"),
        F.col("o.cell").alias("cell_key"),
        "offset",
        "source_size",
        "target",
        "epochs",
        "rest",
    )
    inside = (
        Window.partitionBy("source", "cell")
        .orderBy("key", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranked.join(
        facts, F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("cell") == F.col("cell_key"))
    )
    left = F.col("rest") - F.col("offset") - F.col("inside")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )
