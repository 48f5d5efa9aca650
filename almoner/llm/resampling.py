"""Target-distribution importance resampling: weights from hashed features, then an exact cut by bracketing.

A document's weight is the sum over its features of how much likelier their buckets are in the target texts than
in the corpus; Gumbel noise from a hash of its id turns a draw without replacement into taking the highest scores.
The cut is found without sorting the scores: a mergeable quantile sketch names a bracket, exact counts outside and
inside say whether the cut lies in it or the bracket must be widened, and it is narrowed until it is small enough to be
sorted. Only drawn rows are ordered for their ranks, in cells whose bounds come from the same kind of sketch.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.session import materialize

# fixed value: bytes that words consist of; capitals are lowered, everything else parts words
_LOWERED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_STORE = 400_000
_ROWS = 20_000


class _Buckets(dict):
    """Buckets of features, kept for a bounded number of features per worker."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(self) >= _STORE:
            self.clear()
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case."""
    return text.translate(_LOWERED).split()


def bucket_ids(words: list[bytes], max_n: int, store: _Buckets) -> np.ndarray:
    """Buckets of all runs of 1 to max_n words, repeats kept."""
    parts = [np.fromiter(map(store.__getitem__, words), np.int64, len(words))]
    for n in range(2, max_n + 1):
        runs = [b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]
        parts.append(np.fromiter(map(store.__getitem__, runs), np.int64, len(runs)))
    return np.concatenate(parts)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for k in range(len(column)):
        yield column[k].as_py() or b""


def feature_counts(rows: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features per bucket over all whole texts; every task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch.column(0)):
                total += np.bincount(bucket_ids(words_of(text), max_n, store), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "features"])

    counted = rows.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(
        run, "bucket long, features long"
    )
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("features").alias("features")).collect():  # one row per bucket
        out[r.bucket] = r.features
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of every bucket, with one added to each count."""
    buckets = len(corpus)
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * (s_all + buckets)) / float((s + 1) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(key: int | None, seed: str) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    h = int.from_bytes(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = 1, seed: str = "2024"
) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row; nothing is shuffled."""
    fields = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Buckets(len(gains))
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                words = words_of(text)
                ids = bucket_ids(words, max_n, store)
                weight = int(gains[ids].sum())
                rows.append((key, len(words), len(ids), weight, weight + noise(key, seed)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], fields)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return given.mapInArrow(run, ", ".join(f"{f} long" for f in fields))


def kth_smallest(
    rows: DataFrame, keys: list[str], k: int, bracket_rows: int = 100_000, spread: float = 0.002, accuracy: int = 2_000
) -> tuple:
    """The k-th row's values (1-based) in ascending order of the long columns `keys`.

    A bracket of the first key is named by a quantile sketch of the rows still in question; exact counts below, on
    and between its ends say where the k-th row lies. Outside, the bracket is widened; on an end, the next key
    decides among the rows that share it; between, the rows between are what is left. A rest of at most
    `bracket_rows` rows is sorted. Every pass leaves fewer rows, and what reaches the driver is one row of counts.
    """
    key, left, below, total = F.col(keys[0]), rows, 0, rows.count()
    if not 1 <= k <= total:
        raise ValueError(f"there is no row {k} among {total}")
    while total > bracket_rows:
        place, width = (k - below) / total, spread
        while True:
            low, high = max(0.0, place - width), min(1.0, place + width)
            ends = left.agg(F.percentile_approx(key, [low, high], accuracy).alias("ends"), F.min(key), F.max(key)).first()
            lo = ends[1] if low == 0 else ends[0][0]
            hi = ends[2] if high == 1 else ends[0][1]
            seen = left.agg(
                F.count_if(key < lo).alias("under"),
                F.count_if(key == lo).alias("on_lo"),
                F.count_if((key > lo) & (key < hi)).alias("inside"),
                F.count_if((key == hi) & (key > lo)).alias("on_hi"),
            ).first()
            steps = np.cumsum([below + seen.under, seen.on_lo, seen.inside, seen.on_hi]).tolist()
            if steps[0] < k <= steps[3]:
                break
            width *= 8
        if k <= steps[1] or k > steps[2]:
            value, before = (lo, steps[0]) if k <= steps[1] else (hi, steps[2])
            ties = left.where(key == value)
            if len(keys) == 1:
                return (value,)
            return (value, *kth_smallest(ties, keys[1:], k - before, bracket_rows, spread, accuracy))
        left, below, total = left.where((key > lo) & (key < hi)), steps[1], seen.inside
    return tuple(left.orderBy(*keys).select(*keys).offset(k - below - 1).limit(1).first())


def _ranked(drawn: DataFrame, order: list[str], cells: int) -> DataFrame:
    """`drawn` with rank 1, 2, 3... by `order`: cells between sketched bounds, and the rows before each cell."""
    at = [k / cells for k in range(1, cells)]
    bounds = sorted(set(drawn.agg(F.percentile_approx(order[0], at, 4 * cells)).first()[0] or []))
    cell: Column = F.lit(0)
    if bounds:
        cell = F.aggregate(
            F.array(*map(F.lit, bounds)), F.lit(0), lambda n, b: n + (F.col(order[0]) > b).cast("int")
        )
    placed = drawn.withColumn("cell", cell)
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("cell").agg(F.count("*").alias("held"))  # one row per cell
    offsets = counts.select("cell", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("cell").orderBy(*order))
    return placed.withColumn("inside", inside).join(F.broadcast(offsets), "cell").withColumn(
        "rank", (F.col("offset") + F.col("inside")).cast("long")
    )


def resample_to_target(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_n: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: str = "2024",
    cells: int = 256,
    bracket_rows: int = 100_000,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn).

    Features are all runs of 1 to max_n words of the whole text, hashed to `buckets`; a bucket's gain compares the
    target's texts with all documents. Of the N rows with at least min_words words, floor(percent * N / 100) with
    the highest scores are drawn, ties to the smaller doc_id.

    Null and empty texts have no features, weigh 0 and are never drawn. Null ids hash like an empty one and come after
    all others of the same score. Rows that repeat an id and a text are drawn one by one; which of
    them has which rank is not told apart. Without target texts, gains favour what is rare in the corpus; an empty
    table gives an empty result. Other columns are ignored. Bounded by parameters: `buckets` gains in every
    task, `bracket_rows` keys sorted for the cut, `cells` bounds. The noise spreads equal weights, so that one score
    holds at most about 0.04 % of rows with different ids.
    """
    corpus = feature_counts(docs, text_col, max_n, buckets)
    gains = bucket_gains(corpus, feature_counts(target, target_col, max_n, buckets))
    scored = materialize(score_documents(docs, gains, id_col, text_col, max_n, seed))
    # ascending keys: the highest score first, then the smallest id, null ids last
    keyed = scored.withColumns({"low": -F.col("score"), "tie": F.coalesce("doc_id", F.lit((1 << 63) - 1))})
    columns = ["doc_id", "n_features", "weight", "score"]
    can = F.col("n_words") >= min_words
    draw = scored.where(can).count() * percent // 100
    if not draw:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    low, tie = kth_smallest(keyed.where(can), ["low", "tie"], draw, bracket_rows)
    ahead = can & ((F.col("low") < low) | ((F.col("low") == low) & (F.col("tie") <= tie)))
    ranked = _ranked(keyed.where(ahead), ["low", "tie"], cells)
    rank = F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")  # rows that repeat the cut's id may pass it
    rest = keyed.where(~ahead).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank).unionByName(rest)
