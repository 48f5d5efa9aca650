"""Global ranks, prefix sums and exact cut points without a single-partition window.

Rows are range-partitioned on the full sort key and stamped with their position. The stamped
frame is checkpointed, because range boundaries are sampled: two runs of the same plan need not
agree on them. Only one row per partition is ever brought together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from almoner.session import materialize

_POS = "__pos"
_PART = "__part"
_FACTS = "__facts"
# monotonically_increasing_id puts the partition number above bit 33 and the row number below it.
_ROW_BITS = 33


def attach(df: DataFrame, facts: DataFrame, name: str = _FACTS) -> DataFrame:
    """Add the only row of `facts` to every row as a struct, through one scalar subquery."""
    return df.withColumn(name, facts.select(F.struct(*facts.columns)).scalar())


def _partitions(df: DataFrame) -> int:
    """Range partitions to cut into: what shuffles start with before they are coalesced."""
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(conf.get("spark.sql.shuffle.partitions")), int(initial or 0))


def _stamped(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    n = partitions or _partitions(df)
    return materialize(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(_POS, F.monotonically_increasing_id())
    )


def _part() -> Column:
    return F.shiftright(F.col(_POS), _ROW_BITS)


def _row_in_part() -> Column:
    return F.col(_POS).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def _with_offsets(stamped: DataFrame, amount: Column, out: str) -> DataFrame:
    """Add `out`: the sum of `amount` over all partitions before the row's own."""
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = (
        stamped.groupBy(_part().alias(_PART))
        .agg(F.sum(amount).alias("__total"))
        .select(_PART, F.coalesce(F.sum("__total").over(before), zero).alias(out))
    )
    # one row per partition, so its size is set by the partition count and not by the data
    return stamped.withColumn(_PART, _part()).join(F.broadcast(offsets), _PART)


def global_rank(
    df: DataFrame, order: Sequence[Column], out: str = "rank", partitions: int | None = None
) -> DataFrame:
    """1-based row number over the whole frame. `order` must end in a unique tie-break."""
    ranked = _with_offsets(_stamped(df, order, partitions), F.lit(1), "__before")
    return ranked.withColumn(out, F.col("__before") + _row_in_part() + 1).drop(
        "__before", _PART, _POS
    )


def prefix_sum(
    df: DataFrame,
    amount: str,
    order: Sequence[Column],
    out: str = "running",
    partitions: int | None = None,
) -> DataFrame:
    """Running sum of `amount` over the whole frame in the given unique order."""
    return _running(_stamped(df, order, partitions), amount, out)


def _running(stamped: DataFrame, amount: str, out: str) -> DataFrame:
    summed = _with_offsets(stamped, F.col(amount), "__before")
    within = Window.partitionBy(_PART).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    return summed.withColumn(out, F.col("__before") + F.sum(amount).over(within)).drop(
        "__before", _PART, _POS
    )


def _stacked(df: DataFrame, columns: Mapping[str, Column], *keep: str) -> DataFrame:
    """One (metric, value) row per named column; null values leave the ranking."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in columns.items()]
    )
    return (
        df.select(*keep, F.explode(pairs).alias("__p"))
        .select(*keep, "__p.metric", "__p.v")
        .where(F.col("v").isNotNull())
    )


def _metric_spans(ranked: DataFrame, weight: Column) -> DataFrame:
    """Rows per metric and rows before it; one row per metric name."""
    before = Window.orderBy("metric").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.groupBy("metric")
        .agg(F.sum(weight).alias("n"))
        .select("metric", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )


def first_rank_cuts(
    df: DataFrame, key: str, columns: Mapping[str, Column], bins: int = 5
) -> DataFrame:
    """One row; per metric an array of the (value, key) pairs that end each of the first bins.

    With ranks 1..n by value and then key, bin j ends at rank floor(j * (n - 1) / bins) + 1.
    """
    ranked = global_rank(
        _stacked(df, columns, key), [F.asc("metric"), F.asc("v"), F.asc(key)], "__g"
    )
    placed = ranked.join(F.broadcast(_metric_spans(ranked, F.lit(1))), "metric")
    in_metric = F.col("__g") - F.col("start") - 1
    ends = [F.floor(F.lit(j) * (F.col("n") - 1) / bins) for j in range(1, bins)]
    at_end = placed.select("metric", "v", key, "n", in_metric.alias("__i")).where(
        F.col("__i").isin(*ends)
    )
    return at_end.agg(
        *[
            F.array(
                *[
                    F.max(F.when((F.col("metric") == m) & (F.col("__i") == end), F.struct("v", key)))
                    for end in ends
                ]
            ).alias(m)
            for m in columns
        ]
    )


def bin_of(value: Column, cuts: Sequence[Column]) -> Column:
    """1 + the number of cut points below `value`; a missing cut point counts as below."""
    above = [F.when(F.coalesce(value > c, F.lit(True)), 1).otherwise(0) for c in cuts]
    total = F.lit(1)
    for step in above:
        total = total + step
    return F.when(value.isNotNull(), total)


def quintiles(
    df: DataFrame, key: str, columns: Mapping[str, Column], reverse: Sequence[str] = ()
) -> DataFrame:
    """Add one 1-5 score per named column from the rank by value and then key.

    The cut points come from one ranking of all columns together; scoring itself moves no rows.
    """
    out = attach(df, first_rank_cuts(df, key, columns))
    cuts = F.col(_FACTS)
    for name, column in columns.items():
        pair = F.struct(column.cast("double").alias("v"), F.col(key))
        score = bin_of(pair, [cuts[name][j] for j in range(4)])
        score = F.when(column.isNotNull(), score)
        out = out.withColumn(name, 6 - score if name in reverse else score)
    return out.drop(_FACTS)


class Ranks:
    """What a selection knows of one metric: its rows, and near each probability the distinct values with their ranks."""

    def __init__(self, n: int, near: Mapping[float, Sequence[tuple[float, int, int]]]):
        self.n, self.near = n, near

    def at(self, prob: float, place: int) -> tuple[float, int, int]:
        """(value, rows below it, its rows) at a 0-based place close to `prob`."""
        return next(x for x in self.near[prob] if x[1] <= place < x[1] + x[2])

    def quantile(self, prob: float) -> float | None:
        """Quantile with linear interpolation; None without rows."""
        if not self.n:
            return None
        target = prob * (self.n - 1)
        low, high = self.at(prob, math.floor(target))[0], self.at(prob, math.ceil(target))[0]
        return low + (high - low) * (target - math.floor(target))

    def percent_cut(self, prob: float) -> float | None:
        """The largest value whose average percent rank is at most `prob`; None if there is none.

        The value at place floor(prob * n) is it, or the distinct value before it is.
        """
        place = math.floor(prob * self.n) - 1
        if place < 0:
            return None
        value, before, held = self.at(prob, place)
        if (before + (held + 1) / 2) / self.n <= prob:
            return value
        return self.at(prob, before - 1)[0] if before else None


def select_ranks(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], most: int = 2_000, accuracy: int = 10_000
) -> dict[str, Ranks]:
    """Values around the given probabilities of several metrics, exactly and without sorting or moving rows.

    One pass over `df` takes a quantile sketch of every metric, which names a bracket around each wanted place. A second
    one counts the rows below and above each bracket and, by value, those inside, and keeps the values next to the
    bracket. Exact counts show whether the wanted places lie inside or right beside it, so that a bracket of one frequent
    value is enough. If not, that bracket alone is widened, and if the values inside all brackets are too many for the
    driver (`most` per bracket), they are narrowed by sketches of what is inside; `most` is only doubled when that does not
    leave fewer rows. Nulls do not count.
    """
    value = {m: c.cast("double") for m, c in columns.items()}
    # the probes that are still open, with what is known of them: no ends at first
    probes = [(m, p) for m in columns for p in probs]
    ends: dict[tuple[str, float], tuple[float | None, float | None]] = dict.fromkeys(probes, (None, None))
    spread = dict.fromkeys(probes, 2.0 / accuracy)
    shares = {(m, p): (p - spread[m, p], p + spread[m, p]) for m, p in probes}
    near: dict[tuple[str, float], list[tuple[float, int, int]]] = {}
    counts = {m: 0 for m in columns}

    def within(m: str, p: float) -> Column:
        low, high = ends[m, p]
        test = value[m].isNotNull()
        return test if low is None else test & (value[m] >= F.lit(low)) & (value[m] <= F.lit(high))

    def wanted(m: str, p: float) -> tuple[int, int]:
        """First and last 0-based place that may be asked for."""
        return max(0, math.floor(p * counts[m]) - 1), min(counts[m] - 1, math.ceil(p * counts[m]))

    def sketch() -> None:
        """New brackets from sketches of what was inside the old ones."""
        parts = []
        for k, x in enumerate(probes):
            v = F.when(within(*x), value[x[0]])
            low, high = (min(1.0, max(0.0, s)) for s in shares[x])
            parts += [F.percentile_approx(v, [low, high], accuracy).alias(f"q{k}"), F.min(v).alias(f"lo{k}"), F.max(v).alias(f"hi{k}")]
        row = df.agg(*parts, *[F.count(value[m]).alias(f"n{j}") for j, m in enumerate(columns)]).first()
        counts.update({m: row[f"n{j}"] for j, m in enumerate(columns)})
        for k, x in enumerate(probes):
            found = row[f"q{k}"]
            if found is not None:
                ends[x] = (row[f"lo{k}"] if shares[x][0] <= 0 else found[0], row[f"hi{k}"] if shares[x][1] >= 1 else found[1])

    def crowd() -> dict[tuple[str, float], tuple[int, int]]:
        """Rows below and inside each bracket."""
        sums = []
        for k, x in enumerate(probes):
            low = ends[x][0]
            sums += [F.count_if(value[x[0]] < F.lit(low)).alias(f"b{k}"), F.count_if(within(*x)).alias(f"i{k}")]
        row = df.agg(*sums).first()
        return {x: (row[f"b{k}"], row[f"i{k}"]) for k, x in enumerate(probes)}

    def places(rows: Sequence[Row], m: str, p: float) -> list[tuple[float, int, int]] | None:
        """(value, rows below it, its rows) in the bracket and next to it; None if a wanted place is farther away."""
        side = {r.side: r for r in rows if r.side != 1}
        at = start = side[0].c if 0 in side else 0
        # the values beside the bracket are known, but not all of their rows: one stands for them
        found = [(side[0].most, start - 1, 1)] if 0 in side else []
        for r in sorted((r for r in rows if r.side == 1), key=lambda r: r.v):
            found.append((r.v, at, r.c))
            at += r.c
        if 2 in side:
            found.append((side[2].least, at, 1))
        first, last = wanted(m, p)
        # the rows of the first value count too, so it has to be inside
        return found if not counts[m] or start <= first < at and last <= at else None

    held_before = None
    sketch()
    while True:
        cells = []
        for k, (m, p) in enumerate(probes):
            low, high = ends[m, p]
            v = value[m]
            side = F.when(v < F.lit(low), 0).when(v > F.lit(high), 2).otherwise(1) if low is not None else F.lit(1)
            cells.append(F.struct(F.lit(k).alias("k"), F.when(v.isNotNull(), side).alias("side"), v.alias("x")))
        seen = df.select(F.inline(F.array(*cells))).where("side is not null").groupBy("k", "side", F.when(F.col("side") == 1, F.col("x")).alias("v"))
        limit = (most + 2) * len(probes)
        held = seen.agg(F.count("*").alias("c"), F.min("x").alias("least"), F.max("x").alias("most")).limit(limit + 1).collect()
        if len(held) <= limit:
            held_before, missed = None, []
            for k, x in enumerate(probes):
                found = places([r for r in held if r.k == k], *x)
                if found is None:
                    missed.append(x)
                else:
                    near[x] = found
            if not missed:
                return {m: Ranks(counts[m], {p: near[m, p] for p in probs}) for m in columns}
            probes = missed
            for x in probes:
                spread[x] *= 8
                ends[x], shares[x] = (None, None), (x[1] - spread[x], x[1] + spread[x])
        else:
            sizes = crowd()
            total = sum(n for _, n in sizes.values())
            if held_before is not None and total >= held_before:
                most *= 2  # so that an end is reached even where sketches cannot tell values apart
            held_before = total
            for x, (below, inside) in sizes.items():
                first, last = wanted(*x)
                inside = max(1, inside)
                shares[x] = ((first - below) / inside - spread[x], (last + 1 - below) / inside + spread[x])
        sketch()


def _one_row(df: DataFrame, values: Mapping[str, object], kind: str) -> DataFrame:
    """One row of known values."""
    schema = ", ".join(f"`{name}` {kind}" for name in values)
    return df.sparkSession.createDataFrame([tuple(values.values())], schema)


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """One row of exact quantiles, {alias: (column, probability)}, with linear interpolation."""
    probs = sorted({p for _, p in wanted.values()})
    found = select_ranks(df, {name: column for name, (column, _) in wanted.items()}, probs)
    return _one_row(df, {name: found[name].quantile(p) for name, (_, p) in wanted.items()}, "double")


def value_cuts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """One row; per metric a struct of the six quintile edges and four percent-rank cut points."""
    shares = (0.2, 0.4, 0.6, 0.8)
    found = select_ranks(df, columns, (0.0, *shares, 1.0))
    cuts = {m: ([r.quantile(p) for p in (0.0, *shares, 1.0)], [r.percent_cut(p) for p in shares]) for m, r in found.items()}
    return _one_row(df, cuts, "struct<edges: array<double>, pct: array<double>>")


def robust_scores(df: DataFrame, columns: Mapping[str, tuple[Column, bool]]) -> DataFrame:
    """Add 1-5 value scores, {name: (column, ascending)}.

    Descending scores use the five quintile bins when no edge repeats. Ascending scores only have
    four labels, so they use bins when exactly four remain after repeats are dropped. Everything
    else falls back to the average percent rank.
    """
    out = attach(df, value_cuts(df, {name: column for name, (column, _) in columns.items()}))
    stats = F.col(_FACTS)
    for name, (column, ascending) in columns.items():
        value = column.cast("double")
        edges = F.array_distinct(stats[name]["edges"])
        by_rank = bin_of(value, [stats[name]["pct"][j] for j in range(4)])
        if ascending:
            by_bin = bin_of(value, [edges[j] for j in (1, 2, 3)])
            score = F.when(F.size(edges) == 5, by_bin).otherwise(by_rank)
        else:
            by_bin = 6 - bin_of(value, [stats[name]["edges"][j] for j in (1, 2, 3, 4)])
            score = F.when(F.size(edges) == 6, by_bin).otherwise(6 - by_rank)
        out = out.withColumn(name, score.cast("double"))
    return out.drop(_FACTS)
