"""Toxicity by multiple-instance learning: a document is as toxic as its sentences together.

A sentence has a probability, a logistic function of the words in it; a document's is their noisy-or,
1 - prod(1 - p). The weights are trained from document labels alone: the gradient of the noisy-or hands
the blame for a toxic document to the sentences that already look worst. Words are hashed to a fixed number of
weights, most of which the L1 term leaves at zero.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 20
_PREFIXES = (4, 5, 6, 7, 8)


def buckets(word: str) -> list[int]:
    """A word's weights: its own and those of its beginnings, which inflected and compound forms share."""
    parts = [word + "$", *(word[:k] for k in _PREFIXES if k <= len(word))]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in parts]


@dataclass(frozen=True)
class SentenceModel:
    """Bias of every sentence, and the weights of buckets other than zero."""

    bias: float
    weights: dict[int, float]

    def by_word(self) -> _ByWord:
        return _ByWord(self.weights)


class _ByWord(dict):
    """Weights by word, kept for a bounded number of words per worker."""

    def __init__(self, weights: dict[int, float], most: int = 400_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        weight = sum(self.weights.get(b, 0.0) for b in buckets(word))
        if len(self) >= self.most:
            self.clear()
        if len(word) <= 64:
            self[word] = weight
        return weight


def sentences(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, words' text) of the sentences, ends exclusive, without outer blanks."""
    for m in _SENTENCE.finditer(text):
        part = m.group()
        if kept := part.strip():
            start = m.start() + len(part) - len(part.lstrip())
            yield start, start + len(kept), kept


def score_text(text: str, model: SentenceModel, by_word: _ByWord) -> tuple[float, list[tuple[int, int, float]]]:
    """The document's probability and its sentences with a probability of 0.5 or more.

    A sentence without a telling word has no say, so that a clean text may be as long as it likes.
    """
    clean = 0.0  # log of the probability that no sentence is toxic
    worst = []
    for start, end, part in sentences(text):
        weight = sum(map(by_word.__getitem__, set(_WORD.findall(part.lower()))))
        if weight <= 0.0:
            continue
        z = model.bias + weight
        clean -= float(np.logaddexp(0.0, z))
        if z >= 0:
            worst.append((start, end, float(1 / (1 + np.exp(-z)))))
    return float(-np.expm1(clean)) if clean else 0.0, worst


def fit_sentences(
    texts: list[str], labels: list[int], rounds: int = 400, rate: float = 0.3, l1: float = 2e-4, bias: float = -6.0
) -> SentenceModel:
    """Train weights and bias by proximal Adagrad on the mean log loss of the noisy-or.

    Without texts, or with labels of one kind, the model has the start bias and no weights.
    """
    if len(set(labels)) < 2:
        return SentenceModel(bias, {})
    column: dict[int, int] = {}
    words, owners, docs = [], [], []
    n = 0
    for k, text in enumerate(texts):
        for _, _, part in sentences(text):
            for w in set(_WORD.findall(part.lower())):
                for b in buckets(w):
                    words.append(column.setdefault(b, len(column)))
                    owners.append(n)
            docs.append(k)
            n += 1
    words, owners, docs = np.array(words, np.int64), np.array(owners, np.int64), np.array(docs, np.int64)
    y = np.array(labels, float)
    w, b = np.zeros(len(column)), bias
    gw, gb = np.full(len(column), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(owners, w[words], n)
        clean = np.bincount(docs, -np.logaddexp(0.0, z), len(texts))  # log prod(1 - p)
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        # d loss / d z: p for a clean document, -p * (1 - P) / P for a toxic one
        ratio = np.exp(clean) / np.maximum(-np.expm1(clean), 1e-12)
        g = p * np.where(y[docs] > 0, -ratio[docs], 1.0) / len(texts)
        dw = np.bincount(words, g[owners], len(column))
        db = g.sum()
        gw += dw * dw
        gb += db * db
        step = rate / np.sqrt(gw)
        w = w - step * dw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0.0)
        b -= rate / np.sqrt(gb) * db
    back = {c: k for k, c in column.items()}
    return SentenceModel(float(b), {back[k]: float(w[k]) for k in np.flatnonzero(w)})


def sample_labelled(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int, sample_chars: int
) -> list[tuple[int, str, int]]:
    """At most `sample_rows` labelled (id, text, label) rows outside the held-out fifth, by hash of the id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .where(F.length("text").between(1, sample_chars))
        .join(F.broadcast(known), "doc_id")  # sample_rows rows of 12 bytes at most
        .select("doc_id", "text", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(sample_rows)
        .collect()
    )
    return [(r.doc_id, r.text, r.label) for r in rows]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 6_000,
    sample_chars: int = 20_000,
    with_sentences: bool = True,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and sentences array<struct<start,end,score>>.

    The model is fitted on at most `sample_rows` labelled documents of at most `sample_chars` characters,
    taken by hash of the id, none of them from the fifth where crc32(id as text) mod 5 is 0; that is a bound of
    about 120 million characters for the driver whatever the corpus. Every whole text is scored. `sentences`
    are the spans (code points, ends exclusive) with a sentence probability of 0.5 or more.

    Null and empty texts have no sentence and score 0. Labels other than 0 and 1, and null ones, are not learnt; of
    several labels for one id the toxic one counts. A null id is not held out. Without labels of both kinds all
    scores stay low. Repeated rows give repeated results, an empty table none; other columns are ignored.
    """
    model = fit_documents(docs, labels, id_col, text_col, label_col, sample_rows, sample_chars)
    return apply_model(docs, model, id_col, text_col, with_sentences)


def fit_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = 6_000, sample_chars: int = 20_000,
) -> SentenceModel:
    """Model fitted on a bounded sample of labelled documents; see score_toxicity."""
    rows = sample_labelled(docs, labels, id_col, text_col, label_col, sample_rows, sample_chars)
    return fit_sentences([r[1] for r in rows], [r[2] for r in rows])


def score_column(text: Column, model: SentenceModel) -> Column:
    """The score of whole texts as a column, for filters that keep all other columns."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by_word = model.by_word()
        for texts in batches:
            yield pd.Series([score_text(t or "", model, by_word)[0] for t in texts], dtype="float64")

    return F.pandas_udf(score, "double")(text.cast("string"))


def apply_model(
    docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text", with_sentences: bool = True
) -> DataFrame:
    """Score documents with a fitted model; see score_toxicity. Nothing is shuffled."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word = model.by_word()
        for batch in batches:
            texts = batch.column(1)
            made = [score_text(texts[k].as_py() or "", model, by_word) for k in range(batch.num_rows)]
            columns = [batch.column(0), pa.array([m[0] for m in made], pa.float64())]
            names = ["doc_id", "score"]
            if with_sentences:
                columns.append(
                    pa.array([[{"start": s, "end": e, "score": p} for s, e, p in m[1]] for m in made], pa.list_(span))
                )
                names.append("sentences")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, score double"
    if with_sentences:
        schema += ", sentences array<struct<start: long, end: long, score: double>>"
    scored = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(run, schema)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *(["sentences"] if with_sentences else []),
    )
