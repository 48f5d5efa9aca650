"""Fill-in-the-middle by displacement scatter: whole batches of texts are rearranged as one array of bytes.

A text falls into prefix, middle and suffix at two line ends drawn from a hash of its id. Within one part every byte
moves by the same distance, so a difference array holds the change of distance where a part begins, its
cumulative sum is the displacement of every byte of the batch, and one scatter writes all outputs. Restoring finds
the three marks in each output, lays the same kind of array over the restored text and gathers the bytes back.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the marks and forms
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
_SLICE = 2_000_000  # bytes rearranged at once; a longer text is a slice of its own


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of some rows at a time; nulls count as empty."""
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def _displacements(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """Place plus displacement of each of `size` bytes; part k begins at starts[k] and moves by shifts[k].

    Empty parts share their start with the next one, and their changes cancel out in the sum.
    """
    kind = np.int32 if size < 1 << 30 else np.int64
    change = np.zeros(size + 1, kind)
    np.add.at(change, starts, np.diff(shifts, prepend=0).astype(kind))
    at = np.cumsum(change[:size], dtype=kind)
    at += np.arange(size, dtype=kind)
    return at


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all marks and the rows they lie in."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(data[:-2] == PREFIX[0])
    at = at[(data[at + 2] == PREFIX[2]) & np.isin(data[at + 1], [PREFIX[1], SUFFIX[1], MIDDLE[1]])]
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[row + 1]
    return at[inside], row[inside]


def _place(row: np.ndarray, column: np.ndarray, marks: np.ndarray) -> None:
    for k, byte in enumerate(marks):
        row[column + k] = byte


def _draws(keys: list, seed: str) -> np.ndarray:
    """h1 to h4 of each id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).digest()[:16] for k in keys)
    return np.array(struct.unpack(f">{4 * len(keys)}I", digests), np.int64).reshape(len(keys), 4)


def rearrange(
    data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, rate: int, spm_rate: int
) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Outputs of a slice as (bytes, offsets), and n, form, prefix_chars, middle_chars per row."""
    rows, (begin, end) = len(offsets) - 1, (offsets[:-1], offsets[1:])
    # scan the cuts: a unit ends behind a line feed or where the text ends
    feeds = np.flatnonzero(data == 10)
    seen, until = np.searchsorted(feeds, begin), np.searchsorted(feeds, end)
    full = until - seen
    open_end = np.zeros(rows, bool)
    some = end > begin
    open_end[some] = data[end[some] - 1] != 10
    n = full + open_end
    a, b = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1).T

    def behind(units: np.ndarray) -> np.ndarray:
        if not len(feeds):
            return np.where(units == 0, begin, end)
        last = feeds[np.clip(seen + units - 1, 0, len(feeds) - 1)] + 1
        return np.where(units == 0, begin, np.where(units <= full, last, end))

    one, two = behind(a), behind(b)
    form = np.where(draws[:, 3] % 100 < spm_rate, SPM, PSM)
    form[_marks(data, offsets)[1]] = PLAIN
    form[~some | (draws[:, 2] % 100 >= rate)] = PLAIN
    moved = form != PLAIN
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + 9 * moved)])
    o = out_offsets[:-1]
    p, s = one - begin, end - two
    # where the three parts go
    to_prefix = np.select([form == PSM, form == SPM], [o + 3, o + s + 6], o)
    to_suffix = np.select([form == PSM, form == SPM], [o + p + 6, o + 3], o + two - begin)
    to_middle = np.where(moved, o + p + s + 9, o + one - begin)
    starts = np.stack([begin, one, two], 1).ravel()
    shifts = np.stack([to_prefix - begin, to_middle - one, to_suffix - two], 1).ravel()
    out = np.empty(int(out_offsets[-1]), np.uint8)
    out[_displacements(starts, shifts, len(data))] = data
    for to, mark in ((to_prefix, PREFIX), (to_suffix, SUFFIX), (to_middle, MIDDLE)):
        _place(out, (to - 3)[moved], mark)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    facts = {"n": n, "form": form, "prefix_chars": chars[one] - chars[begin], "middle_chars": chars[two] - chars[one]}
    return out, out_offsets, facts


def gather_back(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of a slice of outputs as (bytes, offsets)."""
    begin, end = offsets[:-1], offsets[1:]
    moved = form != PLAIN
    at, row = _marks(data, offsets)
    at, row = at[moved[row]], row[moved[row]]
    if not np.array_equal(row, np.repeat(np.flatnonzero(moved), 3)):
        raise ValueError("an output that is not plain must hold each mark once")
    first, second, third = (np.zeros(len(begin), np.int64) for _ in range(3))
    first[moved], second[moved], third[moved] = at.reshape(-1, 3).T
    psm = form == PSM
    # (start, length) of the parts in the output; a plain text is all prefix
    prefix = np.select([psm, moved], [first + 3, second + 3], begin)
    p = np.select([psm, moved], [second - first - 3, third - second - 3], end - begin)
    suffix = np.select([psm, moved], [second + 3, first + 3], end)
    s = np.select([psm, moved], [third - second - 3, second - first - 3], 0)
    middle = np.where(moved, third + 3, end)
    m = end - middle
    text_offsets = np.concatenate([[0], np.cumsum(p + m + s)])
    t = text_offsets[:-1]
    starts = np.stack([t, t + p, t + p + m], 1).ravel()
    shifts = np.stack([prefix - t, middle - t - p, suffix - t - p - m], 1).ravel()
    return data[_displacements(starts, shifts, int(text_offsets[-1]))], text_offsets


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "7",
    rate: int = 100,
    spm_rate: int = 50,
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    n counts the lines of the whole text, each with its line feed. Of the four numbers h1 to h4 in the first 16
    bytes of sha256("<seed>:<doc_id>"), the first two, modulo n + 1, say after how many lines the prefix and the
    middle end. A text is `plain`, and its own output, if it is empty or null, holds a mark itself, or has
    h3 % 100 >= rate; else it is `spm` if h4 % 100 < spm_rate and `psm` if not. prefix_chars and middle_chars
    count code points and are null for plain texts.

    A null id draws like an empty one. Repeated rows give equal results, an empty table none; other
    columns are ignored. Nothing is shuffled, and a task holds one slice of some texts, or one longer text, at a
    time with about ten bytes of work space per byte.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in _slices(batch.column(1)):
                keys = batch.column(0).slice(first, end - first)
                out, ends, facts = rearrange(data, offsets, _draws(keys.to_pylist(), seed), rate, spm_rate)
                plain = facts["form"] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array(facts["n"].astype(np.int64)),
                        pa.array(np.array(FORMS)[facts["form"]]),
                        pa.array(facts["prefix_chars"].astype(np.int64), mask=plain),
                        pa.array(facts["middle_chars"].astype(np.int64), mask=plain),
                        _binary(out, ends),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    made = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restore_text(rows: DataFrame, output_col: str = "output", form_col: str = "form", out_col: str = "text") -> DataFrame:
    """`rows` with the text that each output was made from, rebuilt from the output and the form alone.

    A null output or form is restored as if it were an empty or a plain one. An output of another form that does not
    hold each mark once is an error. A column of `rows` named `out_col` is replaced; all others stay.
    """
    kept = [c for c in rows.columns if c not in (output_col, out_col)]
    schema = rows.select(*kept).schema.add(output_col, "binary").add(out_col, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = np.array([FORMS.index(f or "plain") for f in batch.column(form_col).to_pylist()], np.int64)
            for first, end, data, offsets in _slices(batch.column(output_col)):
                text, ends = gather_back(data, offsets, forms[first:end])
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, _binary(text, ends)], [*part.schema.names, out_col])

    given = rows.select(*kept, F.col(output_col).cast("string").cast("binary").alias(output_col))
    made = given.mapInArrow(run, schema)
    return made.withColumns({output_col: F.col(output_col).cast("string"), out_col: F.col(out_col).cast("string")})
