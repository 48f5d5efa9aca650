"""Exact deduplication by content sort.

Texts without blanks are range-partitioned between sampled splitters and sorted externally, so equal ones
become neighbours, and a scan compares each text with the one before it in full. The sort key is the
first characters of the text, then its digest, then the order in which rows of a group are preferred: splitters
stay small however long texts are, and a group of copies larger than a partition is cut into several.
A run that touches an end of its partition may go on in the next one; at most two runs per partition do,
and these are put together by their texts, which they carry for this once per run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
_HEAD = 64
_RUNS = (
    "doc_id long, row string, keep_id long, keep_row string, keep_chars long, size long, text_sha256 string, run long, edge string"
)
_ROWS = 20_000


def without_blanks(text: Column) -> Column:
    """The text without [\\x20\\x09-\\x0D]; '' for null."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition, one row per document.

    A run's ids are held until it ends; texts only until the next one is compared. `run` numbers the runs that touch an
    end, and the first row of such a run has the text as its `edge`.
    """
    ids: list = []
    head_chars, digest, text = 0, None, None
    part = TaskContext.get().partitionId() << 1
    first = True
    rows: list[tuple] = []

    def close(last: bool) -> None:
        nonlocal first
        whole, (keep_id, keep_row) = len(ids), ids[0]
        run = part + (not first) if first or last else None
        rows.extend(
            (i, r, keep_id, keep_row, head_chars, whole, digest, run, text if run is not None and k == 0 else None)
            for k, (i, r) in enumerate(ids)
        )
        first = False

    def out() -> pa.RecordBatch:
        names, kinds = zip(*(x.split() for x in _RUNS.split(", ")))
        types = {"long": pa.int64(), "string": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(list(c), types[k]) for c, k in zip(zip(*rows), kinds, strict=True)], list(names))

    for batch in batches:
        keys, chars, digests, texts, own = (batch.column(k) for k in range(5))
        columns = zip(keys.to_pylist(), own.to_pylist(), chars.to_pylist(), digests.to_pylist(), strict=True)
        for k, (key, row, n, d) in enumerate(columns):
            if d != digest or texts[k].as_py() != text:
                if ids:
                    close(False)
                    if len(rows) >= _ROWS:
                        yield out()
                        rows = []
                ids, head_chars, digest, text = [], n, d, texts[k].as_py()
            ids.append((key, row))
    if ids:
        close(True)
        yield out()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after deleting blanks (space, \\t to \\r); null counts as ''. Of equal
    texts the row with most code points in its original text stays, then the one with the smallest id; a null id
    comes after all others. Of repeated rows that agree in id too all are marked as kept, since they
    cannot be told apart. An empty table gives an empty result; other columns are ignored.

    With row_col, a column that is different in every row, the result also has that column and `stays`, true for the one
    row of each group that stays; the smallest row of those that agree in length and id.
    """
    text = F.col("text")
    row = F.col(row_col).cast("string") if row_col else F.lit(None).cast("string")
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("raw"), row.alias("row"))
        .select("doc_id", F.coalesce(F.length("raw"), F.lit(0)).cast("long").alias("n"), without_blanks(F.col("raw")).alias("text"), "row")
        .select("doc_id", "n", F.sha2(text, 256).alias("digest"), "text", "row")
    )
    order = [F.substring("text", 1, _HEAD), F.col("digest"), F.col("n").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = materialize(sorted_.mapInArrow(_runs, _RUNS))
    best = F.min(
        F.struct(
            (-F.col("keep_chars")).alias("c"), F.col("keep_id").isNull().alias("n"), F.col("keep_id").alias("id"), F.col("keep_row").alias("row")
        )
    )
    # at most two rows per partition; equal texts are told by the texts themselves
    edges = runs.where("edge is not null").select("run", "text_sha256", "edge", "keep_chars", "keep_id", "keep_row", "size")
    whole = edges.groupBy("text_sha256", "edge").agg(
        best.getField("id").alias("whole_id"),
        best.getField("row").alias("whole_row"),
        F.sum("size").alias("whole_size"),
        F.collect_list("run").alias("runs"),  # of the partitions that one group goes through
    )
    joined = whole.select(F.explode("runs").alias("edge_run"), "whole_id", "whole_row", "whole_size")
    open_ = F.col("edge_run").isNotNull()
    keep = F.when(open_, F.col("whole_id")).otherwise(F.col("keep_id"))
    out = runs.drop("edge").join(F.broadcast(joined), F.col("run") == F.col("edge_run"), "left")
    columns = [
        F.col("doc_id"),
        keep.alias("keep_id"),
        F.when(open_, F.col("whole_size")).otherwise(F.col("size")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("text_sha256"),
    ]
    if row_col:
        stays = F.when(open_, F.col("whole_row")).otherwise(F.col("keep_row")) == F.col("row")
        columns += [F.col("row").alias(row_col), stays.alias("stays")]
    return out.select(*columns)
