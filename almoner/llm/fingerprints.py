"""Document fingerprints: a homomorphic multiset hash with lanes modulo powers of two.

Every paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors. So the order of paragraphs does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector (`add`, `subtract`). There are two kinds of lanes, all modulo 2**32: 16 uniform
ones from the paragraph's own hash, which make different multisets differ, and 64 that count the bits of
the hashes of its word pairs, together with the number of pairs. From the second kind follows a
likeness: as random signs, two documents' counts correlate as their pairs do.

Two lanes share a long, high and low half, so a fingerprint is 41 longs: pairs, 8 uniform, 32 counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 41
_UNIFORM = 8
_LOW = 0xFFFFFFFF
_BITS = 0x0000000100000001


def paragraphs(text: Column) -> Column:
    """Non-empty stretches between line feeds."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def _pair_hashes(paragraph: Column) -> Column:
    """Hashes of neighbouring words; the last word stands alone too."""

    def pairs(words: Column) -> Column:
        return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))

    # through a list of one, so that the words are split off once and not at every mention
    return F.transform(F.array(F.split(paragraph, " ")), pairs)[0]


def _exploded(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per word pair, with its paragraph's hash; one row of nulls for a text without any."""
    parts = df.select(*keep, F.explode_outer(paragraphs(F.col(text))).alias("p"))
    return parts.select(*keep, F.xxhash64(F.lit("paragraph"), "p").alias("ph"), F.posexplode_outer(_pair_hashes(F.col("p"))).alias("pair", "h"))


def _sums() -> list[Column]:
    """Sums over the rows of _exploded: number of pairs, then halves of uniform lanes, then counting lanes."""
    whole = [F.count("h").alias("f0")]
    for k in range(_UNIFORM):
        lane = F.when(F.col("pair") == 0, F.xxhash64("ph", F.lit(k)))
        whole.append(F.sum(F.shiftrightunsigned(lane, 32)).alias(f"u{k}"))
        whole.append(F.sum(lane.bitwiseAND(F.lit(_LOW))).alias(f"l{k}"))
    for k in range(LANES - 1 - _UNIFORM):
        whole.append(F.sum(F.shiftright("h", k).bitwiseAND(F.lit(_BITS))).alias(f"f{1 + _UNIFORM + k}"))
    return whole


def _packed() -> Column:
    """The fingerprint as array<long> from the sums."""
    zero = F.lit(0).cast("long")
    low = lambda c: F.coalesce(F.col(c), zero).bitwiseAND(F.lit(_LOW))
    lanes = [low("f0")]
    lanes += [F.shiftleft(low(f"u{k}"), 32).bitwiseOR(low(f"l{k}")) for k in range(_UNIFORM)]
    lanes += [F.coalesce(F.col(f"f{k}"), zero) for k in range(1 + _UNIFORM, LANES)]
    return F.array(*lanes)


def _by_lane(a: Column, b: Column, sign: int) -> Column:
    def lane(x: Column, y: Column) -> Column:
        low = (x.bitwiseAND(F.lit(_LOW)) + sign * y.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.zip_with(a, b, lane)


def add(a: Column, b: Column) -> Column:
    """Fingerprint of two multisets together."""
    return _by_lane(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint after `b`'s paragraphs are deleted from `a`'s."""
    return _by_lane(a, b, -1)


def as_text(lanes: Column) -> Column:
    """Hexadecimal text of a fingerprint."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Correlation of two fingerprints' counts, 0 to 1; 1 for equal ones, 0 if only one has pairs.

    The standard error is about 1/8 for documents without common pairs. Counts up to 2**31 pairs are exact.
    """

    def signs(x: Column) -> Column:
        n = F.element_at(x, 1)
        both = F.transform(
            F.slice(x, 2 + _UNIFORM, LANES - 1 - _UNIFORM),
            lambda v: F.array(2 * v.bitwiseAND(F.lit(_LOW)) - n, 2 * F.shiftrightunsigned(v, 32) - n),
        )
        return F.transform(F.flatten(both), lambda v: v.cast("double"))

    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    x, y = signs(a), signs(b)
    size = F.sqrt(total(F.transform(x, lambda v: v * v)) * total(F.transform(y, lambda v: v * v)))
    dot = total(F.zip_with(x, y, lambda v, w: v * w))
    return F.when(a == b, 1.0).when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / size))).otherwise(0.0)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document id: doc_id, lanes array<long>.

    Null and empty texts have all lanes 0. The rows of one id are one multiset, so a long document may come in
    any number of rows cut between paragraphs. An empty table gives an empty result; other columns are ignored.
    Sums are combined before the shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _exploded(rows, "text", "doc_id").groupBy("doc_id").agg(*_sums()).select("doc_id", _packed().alias("lanes"))


def _cells(docs: DataFrame, id_col: str, cells: int) -> DataFrame:
    """Rows with their range `cell`; the first rows of each range once more at the end of the range before.

    Bounds are ids that occur, taken from one approximate quantile pass over the ids alone. The first rows of
    all come again at the end of the last range. Copies have `guest` set.
    """
    key = F.col(id_col)
    fractions = [k / cells for k in range(1, cells)] or [0.5]
    found = docs.agg(
        F.array_sort(F.array_distinct(F.percentile_approx(key, F.array(*map(F.lit, fractions)), 20_000))).alias("s"),
        F.min(key).alias("low"),
        (F.count_if(key.isNull()) > 0).alias("nulls"),
    ).first()
    bounds = found["s"] or []
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = bounds[::step], [bounds[k : k + step] for k in range(0, len(bounds), step)]
    below = lambda xs, c: F.size(F.filter(xs, lambda s: s <= c))
    as_array = lambda xs: F.array(*map(F.lit, xs)).cast("array<long>")
    if bounds:
        block = below(as_array(coarse), key)
        inner = below(F.element_at(F.array(*map(as_array, fine)), F.greatest(block, F.lit(1))), key)
        cell = F.when(key.isNull() | (block == 0), 0).otherwise((block - 1) * step + inner)
        starts = F.array_contains(F.element_at(F.array(*map(as_array, fine)), F.greatest(block, F.lit(1))), key)
    else:
        cell, starts = F.lit(0), F.lit(False)
    first = key.isNull() if found["nulls"] else key == found["low"]
    places = F.array_compact(
        F.array(
            F.struct(F.col("cell"), F.lit(False).alias("guest")),
            F.when(F.coalesce(starts, F.lit(False)), F.struct((F.col("cell") - 1).alias("cell"), F.lit(True).alias("guest"))),
            F.when(first, F.struct(F.lit(len(bounds)).alias("cell"), F.lit(True).alias("guest"))),
        )
    )
    rows = docs.withColumn("cell", cell.cast("int")).withColumn("place", F.explode(places))
    return rows.withColumns({"cell": F.col("place.cell"), "guest": F.col("place.guest")}).drop("place")


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int | None = None
) -> DataFrame:
    """Fingerprints of documents and of texts edited with the next document.

    One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the
    next document in ascending id order, or all of it if it is shorter; the last document is followed by the
    first. Null ids come first, rows with one id in the order of their texts; null texts count as empty. A
    single document follows itself; an empty table gives an empty result; other columns are ignored.

    The texts are shuffled once, into ranges of ids; all later steps work inside a range.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    if cells is None:
        cells = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("cell").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    chars, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    placed = _cells(rows, "doc_id", cells).withColumns(
        {"at": F.row_number().over(order), "next": F.lead("text").over(order)}
    )
    edited = F.concat(F.left("text", chars - half), F.left(F.coalesce("next", F.lit("")), half))
    versions = placed.withColumn("edited", edited).select(
        "cell",
        "at",
        "guest",
        "doc_id",
        chars.cast("long").alias("n_chars"),
        F.when(~F.col("guest"), F.unhex(F.sha2("edited", 256))).alias("sha"),
        F.explode(
            F.when(F.col("guest"), F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")))).otherwise(
                F.array(
                    F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
                    F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")),
                )
            )
        ).alias("v"),
    )
    keys = ["cell", "at", "guest", "doc_id", "n_chars", "sha", "version"]
    flat = versions.select(*keys[:-1], "v.version", "v.body")
    prints = _exploded(flat, "body", *keys).groupBy(*keys).agg(*_sums())
    prints = prints.select(*keys, _packed().alias("lanes"))
    # own and edited fingerprint of each row follow each other, then those of the next row
    line = Window.partitionBy("cell").orderBy("at", "version")
    beside = prints.withColumns({"edited": F.lead("lanes", 1).over(line), "after": F.lead("lanes", 2).over(line)})
    return beside.where("version = 0 and not guest").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        as_text(F.col("lanes")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("after")).alias("near_next"),
    )
