"""SentencePiece encoding and decoding: exact merge-type (BPE) encoding by backtracking.

A greedy merge encoding is the only split of a text into pieces in which every two neighbours, taken
alone, merge back to exactly these two pieces. So the encoder walks from left to right, takes the longest
vocabulary piece that starts at the position (an Aho-Corasick automaton over the reversed text gives it
for every position in one pass), falls back to shorter pieces while the pair with the piece before it does
not re-merge to itself, and steps back when none is left. The pieces before a position are unique, so one
bit per position remembers that nothing valid starts there and no position fails twice.

Pieces never continue over the space mark, so texts are split there and encodings of short words are kept,
in a store of bounded size per Python worker.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # what the format puts for a space
_STORE = 64 << 20  # bytes of a generation of one store of words, about
_ENTRY = 250  # bytes that a kept word takes beside its own and its ids' characters
_LONG = 48  # characters; longer words are not kept
_PAIRS = 200_000
_SLICE = 1_000_000  # characters encoded before their rows are handed on


class PieceEncoder:
    """Encoder and decoder of one merge-type model file with byte fallback, a dummy prefix and no rewriting."""

    def __init__(self, model_file: str, store_bytes: int = _STORE):
        self.store_bytes = store_bytes
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.ids, self.rank, self.bytes = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.rank[piece] = -model.get_score(i)
        if len(self.bytes) != 256 or model.encode(" a  b ") != model.encode(" a  b ".replace(" ", MARK)):
            raise ValueError("the model must be a merge model with byte fallback that keeps blanks")
        #: no piece has the mark after another character, so a text falls apart before each word's mark
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.lines = not any("\n" in p for p in self.ids if len(p) > 1)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece[::-1], piece)
        self.automaton.make_automaton()
        self.shown = _Shown(self.ids, self.bytes)
        self.own = {piece: piece for piece in self.ids}
        self.shorter: dict[str, str] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.first, self.later = _Words(self, ""), _Words(self, MARK)

    def merge(self, text: str) -> list[str]:
        """Merge a short text step by step: always the best-ranked neighbours, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = min(
                ((self.rank[j], k) for k in range(len(parts) - 1) if (j := parts[k] + parts[k + 1]) in self.rank),
                default=None,
            )
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether `right` may follow `left`; an empty `left` asks whether `right` may stand at all."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            known = self.merge(left + right) == ([left, right] if left else [right])
            # kept under the vocabulary's own strings where it has them
            self.pairs[self.own.get(left, left), self.own.get(right, right)] = known
        return known

    def next_shorter(self, piece: str) -> str:
        """The longest vocabulary piece, or single character, that is a proper prefix of `piece`; '' if none."""
        known = self.shorter.get(piece)
        if known is None:
            known = piece[:-1]
            while len(known) > 1 and known not in self.ids:
                known = known[:-1]
            self.shorter[piece] = known
        return known

    def split(self, text: str) -> list[str]:
        """The merge encoding of `text` (marks for spaces, no dummy prefix added) as pieces."""
        n = len(text)
        longest, last = list(text), n
        for end, piece in self.automaton.iter(text[::-1]):
            if end != last:  # of the pieces that start at one place, the longest comes first
                longest[n - 1 - end] = piece
                last = end
        failed, any_failed = bytearray(n // 8 + 1), False
        pieces: list[str] = []
        at, before, known = 0, "", self.pairs.get
        while at < n:
            piece = longest[at]
            while True:
                if not any_failed and known((before, piece)):
                    break
                while piece:
                    end = at + len(piece)
                    if not failed[end >> 3] >> (end & 7) & 1 and self.fits(before, piece):
                        break
                    piece = self.next_shorter(piece)
                if piece:
                    break
                # nothing valid starts here: step back and go on with the piece before, made shorter
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                piece = pieces.pop()
                at -= len(piece)
                before = pieces[-1] if pieces else ""
                piece = self.next_shorter(piece)
            pieces.append(piece)
            at += len(piece)
            before = piece
        return pieces

    def word(self, text: str) -> str:
        """Ids of a piece of text (marks for spaces) in decimal, joined by spaces."""
        if len(text) <= 16 and text in self.ids and self.fits("", text):
            return self.shown[text]
        return " ".join(map(self.shown.__getitem__, self.split(text)))

    def encode(self, text: str) -> str:
        """Ids of a whole text without end id, in decimal, joined by spaces."""
        if not text:
            return ""
        if not (self.splits and self.lines) or MARK in text:
            return self.word(MARK + text.replace(" ", MARK))
        shown: list[str] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                shown.append(self.first["\n"])
            if "  " in line or line[:1] == " " or line[-1:] == " ":
                shown += [self.word(x.replace(" ", MARK)) for x in self.runs(line if k else " " + line)]
            elif k:
                words = line.split(" ")
                if line:
                    shown.append(self.first[words[0]])
                    shown += map(self.later.__getitem__, words[1:])
            else:  # the format puts a space before the text
                shown += map(self.later.__getitem__, line.split(" "))
        return " ".join(shown)

    def runs(self, line: str) -> list[str]:
        """Split a line before each run of spaces; runs belong to the word behind them."""
        out, start = [], 0
        for k in range(1, len(line)):
            if line[k] == " " and line[k - 1] != " ":
                out.append(line[start:k])
                start = k
        return [x for x in [*out, line[start:]] if x]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


class _Shown(dict):
    """Ids of pieces in decimal; those of a character outside the vocabulary are those of its bytes."""

    def __init__(self, ids: dict[str, int], byte_ids: dict[int, int]):
        super().__init__((piece, str(i)) for piece, i in ids.items())
        self.byte_ids = byte_ids

    def __missing__(self, piece: str) -> str:
        return " ".join(str(self.byte_ids[b]) for b in piece.encode("utf-8", "surrogatepass"))


class _Words(dict):
    """Encodings of words behind a fixed prefix, made when first asked for.

    Two generations of at most the encoder's store_bytes, about: when the young one is full it becomes the old one, and
    words asked for again return from there, so that frequent words never leave.
    """

    def __init__(self, encoder: PieceEncoder, prefix: str):
        super().__init__()
        self.encoder, self.prefix, self.old, self.held = encoder, prefix, {}, 0

    def __missing__(self, word: str) -> str:
        made = self.old.get(word)
        if made is None:
            made = self.encoder.word(self.prefix + word)
        if len(word) <= _LONG:
            size = _ENTRY + len(word) + len(made)
            if self.held + size > self.encoder.store_bytes:
                self.old, self.held = dict(self), 0
                self.clear()
            self.held += size
            self[word] = made
        return made


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(model_file: str, store_bytes: int = _STORE) -> PieceEncoder:
    """The worker's encoder of a model file, loaded once per Python process."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = PieceEncoder(model_file)
    _ENCODERS[model_file].store_bytes = store_bytes
    return _ENCODERS[model_file]


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(list(values), kind)
    ends = pa.array(accumulate(map(len, values), initial=0), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values)))


def encode_documents(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    with_ids: bool = True,
    store_bytes: int = _STORE,
) -> DataFrame:
    """One row per document: doc_id, ids array<int>, decoded, n_tokens, ids_sha256, decoded_sha256.

    ids are those of the model's own library without sampling, then `end_id` (none if it is None). decoded is
    decode(ids). Null and empty texts have the end id only. Repeated rows give repeated results, an empty
    table none; null ids stay null and other columns are ignored. Nothing is shuffled. `model_file` must be
    readable on every executor, as the libraries are. with_ids=False leaves out ids and decoded. A Python worker
    keeps the ids of words in four stores of about `store_bytes` at most.
    """
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_file, store_bytes)
        gc.disable()  # encoding makes no cycles, and a collection would visit every kept word
        try:
            for batch in batches:
                yield from encode_batch(coder, batch)
        finally:
            gc.enable()

    def encode_batch(coder: PieceEncoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, keys, start = batch.column(1), batch.column(0), 0
        rows: list[tuple] = []
        held = 0
        for k in range(batch.num_rows):
            text = texts[k].as_py() or ""
            shown = coder.encode(text)
            if end_id is not None:
                shown = f"{shown} {end_id}" if shown else str(end_id)
            ids = np.fromstring(shown, np.int32, sep=" ")
            back = coder.decode(ids.tolist())
            row = (
                len(ids),
                hashlib.sha256(shown.encode()).hexdigest(),
                hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
            )
            rows.append((*row, ids, back) if with_ids else row)
            held += len(text)
            if held >= _SLICE or k + 1 == batch.num_rows:
                made = [_column(c, kind) for c, (_, kind) in zip(zip(*rows), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, len(rows)).cast(pa.int64()), *made], ["doc_id", *(n for n, _ in fields)]
                )
                start, rows, held = k + 1, [], 0

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, schema
    )
