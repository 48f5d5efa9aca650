"""Corpus pipeline: five stages over a documents table, each written as Parquet and read again.

toxicity -> exact dedup -> near dedup -> mixing to target weights -> token ids. Every stage works on
all rows the one before kept; all but the last return the columns of the table they are given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.llm.content_sort import exact_groups
from almoner.llm.mixing import mix_sources
from almoner.llm.near_dups import near_duplicates
from almoner.llm.pieces import encode_documents
from almoner.llm.toxicity import fit_documents, score_column
from almoner.session import ensure_checkpoint_dir, materialize

#: SQL cannot express the trained, hashed and tokenising stages; tests compare run() with a plain version.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column of a new name that is different in every row and the same whenever it is read.

    Rows of files are named by file and place. Other frames have no such name, so they are written once with a number.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    try:
        meta = docs.metadataColumn("_metadata")
        key = F.concat_ws(":", F.hex(F.xxhash64(meta["file_path"])), meta["row_index"].cast("string"))
        return docs.select("*", key.alias(name)), name
    except AnalysisException:
        return materialize(docs.withColumn(name, F.monotonically_increasing_id().cast("string"))), name


def _rows(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of numbered `docs` that `wanted` names, without their number."""
    return docs.join(wanted.select(key), key, "left_semi").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not call toxic.

    Null and empty texts score 0 and stay, as do rows with a null id. Every row is judged by its own text, so repeated rows
    share their fate. An empty table stays empty; all columns are handed on.
    """
    model = fit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score_column(F.col("text"), model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the one with the smallest id, then any one.

    Null and blank texts are equal to the empty one, so one row of them stays. Null ids come last; rows that repeat an id
    are rows of their own. An empty table stays empty; all columns are handed on.
    """
    rows, key = _numbered(docs)
    return _rows(rows, key, exact_groups(rows, row_col=key).where("stays"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at 0.8 over five-word shingles: that with the smallest id, then any one.

    Texts without words are linked with nothing and stay. Null ids come last; rows that repeat an id are linked by their
    own texts. An empty table stays empty; all columns are handed on.
    """
    rows, key = _numbered(docs)
    return _rows(rows, key, near_duplicates(rows, shingle=5, percent=80, row_col=key).where("stays"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows as often as the mix begins them: once for each full epoch, once more in the last one.

    The document in which a budget ends is taken whole, so a source may pass its target by less than that document.
    Rows without words, null texts among them, take nothing from a budget and stay once. Null sources are one source;
    repeated rows and rows with a null id are mixed one by one. An empty table stays empty; all columns are handed on.
    """
    rows, key = _numbered(docs)
    mixed = mix_sources(rows, row_col=key)
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    taken = mixed.select(key, times.alias("times")).where("times > 0")
    return rows.join(taken.select(key, F.explode(F.array_repeat(F.lit(0), F.col("times")))).select(key), key).drop(key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with their digests; decoded_sha256 is that of the text the ids decode to.

    Null and empty texts have the end id only; every row has its result, also repeated ones and those with a null id.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_documents(docs, model, store_bytes=24 << 20).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("token ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is a table in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
