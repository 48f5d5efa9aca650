"""Token-id files: documents as zstandard frames with one shared dictionary, and an offset index.

A file holds the documents of one range of ids in ascending order. Each document is compressed on its own, so
that one is read without the others; what single short frames lose is won back by a dictionary trained on
serialised id arrays, whose hash every file carries.

    header   b"TOKIDS1\\n", width of an id in bytes (1), sha256 of the dictionary (32)
    frames   one zstandard frame per document: its ids, little-endian unsigned
    index    doc ids (int64), end offsets of the frames (uint64), numbers of ids (uint64)
    trailer  offset of the index (uint64), number of documents (uint64), b"TOKIDS1\\n"

A task writes under a name of its own attempt and returns it; only returned names count, so lost executors and
repeated attempts leave nothing but files nobody refers to.
"""

from __future__ import annotations

import bisect
import gc
import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almoner.session import ensure_checkpoint_dir, materialize

MAGIC = b"TOKIDS1\n"
_HEADER, _TRAILER = len(MAGIC) + 1 + 32, 16 + len(MAGIC)
_STORE = 400_000
_SLICE = 2_000_000
_JOINED = 50_000
_BLOCK = 8 << 20
_GAP = re.compile(r"(?<=\S)(?= \S)")
_MANIFEST = "part int, path string, docs long, ids long"


def _gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `ids` that begin at `starts`, one behind the other."""
    before = np.cumsum(sizes) - sizes
    return ids[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class _Codes(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


class _WordStore:
    """Ids of the words of many texts; each word is looked up once, and new ones are learned together.

    A word's code is the place of its run in one array of ids. Above _STORE words a new generation begins;
    what is asked for again returns from the one before.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype: str):
        self.learn, self.dtype = learn, dtype
        self.old: _Codes = _Codes()
        self._renew()
        self.old_ids, self.old_starts, self.old_sizes = self.ids, self.starts, self.sizes

    def _renew(self) -> None:
        self.codes = _Codes()
        self.ids = np.zeros(0, self.dtype)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.asked, self.ends = array("i"), array("q")

    def ask(self, words: list[str]) -> int:
        """Note the words of a text; returns its place in the next answer."""
        self.asked.extend(map(self.codes.__getitem__, words))
        self.ends.append(len(self.asked))
        return len(self.ends) - 1

    def _learn_new(self) -> None:
        new = list(islice(self.codes, len(self.sizes), None))
        before = np.fromiter((self.old.get(w, -1) for w in new), np.int64, len(new))
        fresh = before < 0
        ids, sizes = self.learn([w for w, c in zip(new, before.tolist(), strict=True) if c < 0])
        from_starts, from_sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        from_starts[~fresh], from_sizes[~fresh] = self.old_starts[before[~fresh]], self.old_sizes[before[~fresh]]
        from_starts[fresh], from_sizes[fresh] = len(self.old_ids) + np.cumsum(sizes) - sizes, sizes
        found = _gather(np.concatenate([self.old_ids, ids]), from_starts, from_sizes)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(from_sizes) - from_sizes])
        self.sizes = np.concatenate([self.sizes, from_sizes])
        self.ids = np.concatenate([self.ids, found])

    def answer(self) -> tuple[bytes, list[int]]:
        """Serialised ids of all texts asked for since the last answer, and the ends, in bytes, of each."""
        if len(self.codes) > len(self.sizes):
            self._learn_new()
        codes = np.frombuffer(self.asked, np.int32).copy()
        sizes = self.sizes[codes]
        raw = _gather(self.ids, self.starts[codes], sizes).tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.frombuffer(self.ends, np.int64)]
        self.asked, self.ends = array("i"), array("q")
        if len(self.codes) > _STORE:
            self.old, self.old_ids, self.old_starts, self.old_sizes = self.codes, self.ids, self.starts, self.sizes
            self._renew()
        return raw, (upto * self.ids.itemsize).tolist()


class ByteEncoder:
    """A `tokenizers` file applied word by word, with the ids of words kept in a bounded store.

    Byte-level patterns start a new piece at every single space between two visible characters, so a text may
    be cut there, and many new words can be encoded as one text and told apart by the pieces that begin with the space
    or the line feed between them. Texts that hold an added token's string, and all texts of other
    files, are left to the library as they are.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.width = 2 if self.model.get_vocab_size() <= 1 << 16 else 4
        self.type = "H" if self.width == 2 else "I"
        self.words = (
            pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space", True)
            and pre.get("use_regex", True)
            and not spec.get("normalizer")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
            and len(self._ids(["\n"])[0]) == self.width
        )
        self.begins = np.zeros(max(self.model.get_vocab().values(), default=0) + 1, bool)
        if self.words:
            self.begins[[i for piece, i in self.model.get_vocab().items() if piece.startswith(("\u0120", "\u010a"))]] = True
        self.simple = _WordStore(self._learn_words, f"<u{self.width}")
        self.odd = _WordStore(self._learn_pieces, f"<u{self.width}")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.type, e.ids).tobytes() for e in found]

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and their numbers, of words as they follow a space, or the line feed they begin with."""
        ids, sizes = [np.zeros(0, f"<u{self.width}")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), _JOINED):
            part = words[k : k + _JOINED]
            (found,) = self.model.encode_batch_fast([(" " + " ".join(part)).replace(" \n", "\n")], add_special_tokens=False)
            ids.append(np.array(found.ids, f"<u{self.width}"))
            starts = np.flatnonzero(self.begins[ids[-1]])
            if len(starts) != len(part):
                raise ValueError("the tokenizer does not begin a piece at every gap")
            sizes.append(np.diff(starts, append=len(ids[-1])))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and their numbers, of pieces of text that may hold any white space."""
        raw = self._ids(pieces)
        sizes = np.fromiter((len(r) // self.width for r in raw), np.int64, len(raw))
        return np.frombuffer(b"".join(raw), f"<u{self.width}"), sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialised ids of each text."""
        if not self.words:
            return self._ids(texts)
        places: list[tuple[_WordStore | None, int]] = []
        for text in texts:
            flat = text.replace("\n", " ")
            if self.added is not None and self.added.search(text) is not None:
                places.append((None, 0))
            # no white space but single spaces and line feeds, each between two visible characters
            elif text and flat.isprintable() and "  " not in flat and flat[0] != " " != flat[-1]:
                # the first word, too, is looked up behind a line feed, whose one id is left out again
                lines = "\n" + (text if "\n" not in text else text.replace("\n", " \n"))
                places.append((self.simple, self.simple.ask(lines.split(" "))))
            else:
                places.append((self.odd, self.odd.ask(_GAP.split(text) if text else [])))
        answers = {store: store.answer() for store in (self.simple, self.odd)}
        out = []
        for text, (store, k) in zip(texts, places, strict=True):
            if store is None:
                out += self._ids([text])
                continue
            raw, ends = answers[store]
            skipped = self.width if store is self.simple else 0
            out.append(raw[(ends[k - 1] if k else 0) + skipped : ends[k]])
        return out


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(file: str) -> ByteEncoder:
    """The worker's encoder of a tokenizer file, loaded once per Python process."""
    if file not in _ENCODERS:
        _ENCODERS[file] = ByteEncoder(file)
    return _ENCODERS[file]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; file:/x is read as file:///x."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri) if ":" in uri else os.path.abspath(uri))


def train_dictionary(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = 800, sample_chars: int = 10_000, size: int = 65_536,
) -> bytes:
    """Dictionary trained on the serialised ids of at most `sample_rows` texts of at most `sample_chars` characters.

    The texts are taken by hash of id and length; b'' if there are too few to train on.
    """
    text = F.col(text_col).cast("string")
    usable = docs.where(F.length(text).between(1, sample_chars)).select(
        F.xxhash64(F.col(id_col), F.length(text)).alias("h"), text.alias("text")
    )
    # the hashes alone are ranked, so that no task sends more than its share of the texts
    last = usable.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    rows = usable.where(F.col("h") <= F.lit(last)).orderBy("h", "text").limit(sample_rows).collect()
    samples = encoder(tokenizer_file).encode([r.text for r in rows])
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    dictionary: bytes | None = None,
    level: int = 3,
) -> DataFrame:
    """Write all documents to `folder` in ascending id order; returns the manifest (part, path, docs, ids).

    Texts are range-partitioned by id, and each task encodes, compresses and writes its range as one file, with a
    frame in memory at a time and 24 bytes of index per document. Null and empty texts have the end id
    only; null ids come first and are stored as the smallest integer; repeated rows are all stored, ordered by
    text. An empty table gives an empty manifest. `folder` must be reachable from all executors through
    pyarrow.fs. The dictionary, trained if none is given, is stored as dictionary-<sha256>.
    """
    if dictionary is None:
        dictionary = train_dictionary(docs, tokenizer_file, id_col, text_col)
    name = hashlib.sha256(dictionary).hexdigest()
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/dictionary-{name}") as f:
        f.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # encoding makes no cycles, and a collection would visit every kept word
        try:
            yield from written(batches)
        finally:
            gc.enable()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_file)
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True, **_dictionary(dictionary))
        part = TaskContext.get().partitionId()
        to, at = _open(folder)
        target = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        out, end = None, b"" if end_id is None else array(coder.type, [end_id]).tobytes()
        keys, ends, sizes = array("q"), array("Q"), array("Q")
        place = _HEADER
        for ids, texts in _slices(batches):
            if out is None:
                out = to.open_output_stream(f"{at}/{target.rsplit('/', 1)[1]}")
                out.write(MAGIC + bytes([coder.width]) + bytes.fromhex(name))
            for key, raw in zip(ids, coder.encode(texts), strict=True):
                raw += end
                frame = pack.compress(raw)
                out.write(frame)
                place += len(frame)
                keys.append(-(1 << 63) if key is None else key)
                ends.append(place)
                sizes.append(len(raw) // coder.width)
        if out is not None:
            for column in (keys, ends, sizes):
                out.write(column.tobytes())
            out.write(struct.pack("<QQ", place, len(keys)) + MAGIC)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([target]), pa.array([len(keys)]), pa.array([sum(sizes)])],
                ["part", "path", "docs", "ids"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    return materialize(ranged.mapInArrow(run, _MANIFEST))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time."""
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        start, held = 0, []
        chars = 0
        for k in range(batch.num_rows):
            held.append(texts[k].as_py() or "")
            chars += len(held[-1])
            if chars >= _SLICE or k + 1 == batch.num_rows:
                yield keys[start : k + 1], held
                start, held, chars = k + 1, [], 0


class TokenFile:
    """One file opened for reading; the dictionary is looked up beside it and checked against the header."""

    def __init__(self, path: str):
        store, own = _open(path)
        self.file = store.open_input_file(own)
        size = self.file.size()
        begin, count, magic = struct.unpack(f"<QQ{len(MAGIC)}s", self.file.read_at(_TRAILER, size - _TRAILER))
        head = self.file.read_at(_HEADER, 0)
        if magic != MAGIC or not head.startswith(MAGIC):
            raise ValueError(f"{path} is not a token-id file")
        self.width = head[len(MAGIC)]
        name = head[-32:].hex()
        with store.open_input_stream(f"{own.rsplit('/', 1)[0]}/dictionary-{name}") as f:
            raw = f.read()
        if hashlib.sha256(raw).hexdigest() != name:
            raise ValueError(f"the dictionary of {path} was changed")
        self.unpack = zstandard.ZstdDecompressor(**_dictionary(raw))
        index = self.file.read_at(24 * count, begin)
        self.keys = np.frombuffer(index, "<i8", count)
        self.ends = np.frombuffer(index, "<u8", count, 8 * count)
        self.sizes = np.frombuffer(index, "<u8", count, 16 * count)

    def _ids(self, frame: bytes, size: int) -> np.ndarray:
        raw = self.unpack.decompress(frame, max_output_size=max(1, size * self.width))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def document(self, doc_id: int) -> np.ndarray | None:
        """Ids of one document, of which only its own frame is read; None if it is not here."""
        k = bisect.bisect_left(self.keys, doc_id)
        if k == len(self.keys) or self.keys[k] != doc_id:
            return None
        begin = int(self.ends[k - 1]) if k else _HEADER
        return self._ids(self.file.read_at(int(self.ends[k]) - begin, begin), int(self.sizes[k]))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, read in blocks."""
        block, first = b"", _HEADER
        begin = _HEADER
        for key, end, size in zip(self.keys.tolist(), self.ends.tolist(), self.sizes.tolist(), strict=True):
            if end > first + len(block):
                first, block = begin, self.file.read_at(max(_BLOCK, end - begin), begin)
            yield None if key == -(1 << 63) else key, self._ids(block[begin - first : end - first], size)
            begin = end

    def close(self) -> None:
        self.file.close()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it; ids_crc32 is over the ids as little-endian unsigned 32-bit
    integers. Each file is read by one task, in blocks.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, rows = TokenFile(path), []
                for key, ids in source.documents():
                    rows.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(rows) >= 20_000:
                        yield _rows(rows)
                        rows = []
                source.close()
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    spread = placed.select("path", "start").repartition(files)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(docs: DataFrame) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(docs.sparkSession)
    return f"{docs.sparkSession.sparkContext.getCheckpointDir()}/token-ids-{uuid.uuid4().hex}"
