import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
LONG = "word " * 40_000 + "Z" * 5_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "a"),
    (2, "the quick  brown fox\tjumps over the lazy dog again and again\n", "a"),
    (3, "The quick brown fox jumps over the lazy dog again and again", None),
    (4, "", "b"),
    (5, None, "b"),
    (6, " \t\n ", "b"),
    (7, LONG, "c"),
    (8, LONG, "c"),
    (9, "one", None),
    (9, "one", None),
    (10, "Ünïcödé ▁ 日本語 🙂🙂  x\x00y \n\n  two  spaces", "é"),
    (11, "a b\n\nc d e f g h", "c"),
    (None, "no identifier here", "a"),
    (None, None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, long texts, ties, repeated rows, and columns named like the operators' own."""
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    names = "key cell size at next bucket rep component node n own text_sha256 block kept place hub_rep score".split()
    return rows.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names)))


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def by_id(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
