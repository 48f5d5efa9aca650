"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets, and components.

Every shingle visits all slots of a signature in an order of its own, a random permutation, and leaves its rank
plus a random fraction in each; a slot keeps the smallest. Ranks of one shingle are therefore spread over
the slots without repetition, which makes the estimate less noisy than independent hashes do. A document
whose slots are all filled after rank j is finished, since later ranks are larger: long texts need a round
or two. The rounds run over all shingles of a slice of documents at once.

Documents with the same shingle set are one class, known by the sums of two hashes over it. Classes that agree in a
band are candidates. A bucket of candidates is never multiplied out: its members are compared in full with one of
them, its hub, a class that meets many others. Links so found are merged into components, and only pairs of one hub
that lie in different components are left. For these a member is described by its deviation from the hub, the hub
shingles it lacks and the shingles it adds: two members share no more than the smaller of their parts of
the hub and the added shingles they have in common. So a pair can only be linked if

* its parts of the hub alone reach the threshold, which bounds the sizes of partners and is an equi-join on size
  classes, or
* it shares added shingles, at least as many as the hub part leaves open, which is an equi-join on the rarest of
  them (a prefix filter).

Either join loses no link, and its pairs are compared on full sets. While added shingles are shared by very
many members, as in a family within the family, one of these becomes a further hub first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.components import components
from almoner.session import materialize, shuffles_freed

_U = np.uint64
_FAN = 256  # pairs that meet one copy of a hub's set
_DENSE = 64  # pairs per row of deviations above which a further hub is tried first
_SALTS = 8  # tasks a bucket's members are spread over
_BITS = 1 << 24  # of the filter that spares most texts without a partner a second sketch; a multiple of 2 ** 15
_SLICE = 1 << 20  # bytes of text hashed at a time
_rng = np.random.default_rng(20_240_131)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FULL = np.iinfo(np.uint64).max
_powers: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer of the splitmix64 generator (fixed constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(_SLICE, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[start:end]; words are in order and do not overlap."""
    power, inverse = _power_tables()
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        base = starts[k]
        n = np.searchsorted(ends, base + _SLICE, "right") - k
        if n <= 0:  # a word longer than a slice: slice by slice
            h = _U(0)
            for at in range(int(base), int(ends[k]), _SLICE):
                part = _BYTE[data[at : min(at + _SLICE, int(ends[k]))]]
                h = _mix(np.array([h]) + (part * power[: len(part)]).sum(dtype=np.uint64))[0]
            out[k] = h
            k += 1
            continue
        s, e = starts[k : k + n] - base, ends[k : k + n] - base
        part = _BYTE[data[base : base + e[-1]]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power[: len(part)], dtype=np.uint64)])
        out[k : k + n] = _mix((sums[e] - sums[s]) * inverse[s])
        k += n
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of texts lying in `data` at `offsets`, and where each text's begin.

    Words are runs of non-blank bytes with A-Z lowered. A shingle is k words in a row; a text of fewer words
    is one shingle, a text without words has none.
    """
    word = ~_BLANK[data]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    inner = offsets[(offsets > offsets[0]) & (offsets < offsets[-1])] - offsets[0]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    hashes = _word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets - offsets[0])
    grams = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for j in range(k):
        grams = _mix(grams + hashes[j : j + len(grams)] + _U(j + 1))
    out, begin = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(grams[a : b - k + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            h = np.array([b - a], np.uint64)
            for x in hashes[a:b]:
                h = _mix(h ^ x)
            own = _mix(h + _U(7))
        else:
            own = grams[:0]
        out.append(own)
        begin.append(begin[-1] + len(own))
    return (np.concatenate(out) if out else grams[:0]), np.array(begin)


def signatures(elements: np.ndarray, begin: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures, one row of `slots` values per text; a text without elements keeps the maximum.

    A value is the rank in its upper byte and a random fraction below.
    """
    texts = len(begin) - 1
    table = np.full(texts * slots, _FULL, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(begin))
    order = None
    for rank in range(slots):
        draw = _mix(elements + _U((rank + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        pick = rank + (_mix(draw) % _U(slots - rank)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            rows = np.arange(len(elements))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
            order[:, rank] = slot
        np.minimum.at(table, owner * slots + slot, (_U(rank) << _U(56)) | (draw >> _U(8)))
        open_ = (table.reshape(texts, slots) == _FULL).any(axis=1)[owner]
        if not open_.any():
            break
        elements, owner, pick = elements[open_], owner[open_], pick[open_]
        if order is None:  # the permutations, once it is known which shingles need them
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
            order[np.arange(len(elements)), pick] = 0
            order[:, 0] = pick
        else:
            order = order[open_]
    return table.reshape(texts, slots)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of texts of about a slice in bytes, one text at least."""
    data, offsets = _buffers(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1)
        end = min(end, len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1]
        at = end


def _class_keys(elements: np.ndarray, begin: np.ndarray) -> pa.Array:
    """16 bytes per text, the sums of two hashes over its set: equal for equal sets."""
    sums = []
    for seed in (11, 23):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(elements + _U(seed)), dtype=np.uint64)])
        sums.append(total[begin[1:]] - total[begin[:-1]])
    raw = pa.py_buffer(np.stack(sums, 1).astype(">u8").tobytes())
    return pa.Array.from_buffers(pa.binary(16), len(begin) - 1, [None, raw]).cast(pa.binary())


def _sketch(k: int, bands: int, rows: int):
    """Batches whose last column is the text: the columns before it, then set size, class and bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, last = batch.schema.names[:-1], batch.num_columns - 1
            for at, end, data, offsets in _slices(batch.column(last)):
                elements, begin = shingle_sets(data, offsets, k)
                table = signatures(elements, begin, bands * rows)
                keys = np.zeros((end - at, bands), np.uint64)
                for j in range(rows):
                    keys = _mix(keys + table[:, j::rows][:, :bands])
                keys = _mix(keys + np.arange(1, bands + 1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(j).slice(at, end - at) for j in range(last)),
                        pa.array(np.diff(begin).astype(np.int64)),
                        _class_keys(elements, begin),
                        pa.ListArray.from_arrays(
                            np.arange(0, (end - at) * bands + 1, bands, dtype=np.int32), keys.ravel().view(np.int64)
                        ),
                    ],
                    [*given, "n_shingles", "class", "bands"],
                )

    return run


def _sets(k: int, marked: np.ndarray):
    """Batches of doc_id, place and text: doc_id, class and shingle set of the rows whose place is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(1).to_numpy()
            rows = batch.filter(pa.array((marked[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)))
            for at, end, data, offsets in _slices(rows.column(2)):
                elements, begin = shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(at, end - at),
                        _class_keys(elements, begin),
                        pa.ListArray.from_arrays(begin.astype(np.int32), elements.view(np.int64)),
                    ],
                    ["doc_id", "class", "shingles"],
                )

    return run


def bands_for(percent: int, rows: int = 5, miss: float = 2e-5) -> int:
    """Bands after which a pair at the threshold fails to meet with a probability of at most `miss`."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    rows: int = 5,
    miss: float = 2e-5,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their sets of `shingle`-word
    shingles, compared on full sets; component_id is the smallest id reachable over links. Words are runs of
    characters other than space and \\t to \\r, with A-Z lowered; a text of fewer words is one shingle. A
    linked pair of different sets is found unless it agrees in no band (probability `miss` at the threshold,
    less above); every pair that agrees in one is compared, ruled out by an exact bound, or already joined.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat an id are rows
    of their own, linked by their own texts only. Null ids are linked too; a component of null ids alone has a null
    component_id, which counts as its rows' own. An empty table gives an empty result; other columns are ignored.

    With row_col, a column that is different in every row, the result also has that column and `stays`, true for exactly
    one row of each component: the smallest row of the smallest id. Rows without shingles all stay.
    """
    bands = bands_for(percent, rows, miss)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    key = F.col(id_col).cast("long").alias("doc_id")
    own = [F.col(row_col).cast("string").alias("row")] if row_col else []
    with shuffles_freed(docs.sparkSession):
        sketches, names = _named(docs.select(key, *own, text), shingle, percent, bands, rows)
    out = sketches.drop("bands").join(names, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", component).withColumn("kept", component.eqNullSafe(F.col("doc_id")))
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    if not own:
        return out.select(*columns)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row"))
    stay = out.where("n_shingles > 0").groupBy("whole").agg(best.getField("row").alias("best"))
    stays = (F.col("n_shingles") == 0) | (F.col("row") == F.col("best"))
    return out.join(stay, "whole", "left").select(*columns, F.col("row").alias(row_col), stays.alias("stays"))


def _named(texts: DataFrame, shingle: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of `texts` (doc_id, row if there is one, text), and (class, whole, component_id) of their classes."""
    sketches = materialize(
        texts.mapInArrow(
            _sketch(shingle, bands, rows),
            "doc_id long, " + ("row string, " if "row" in texts.columns else "") + "n_shingles long, class binary, bands array<long>",
        )
    )
    # the number of a class is fixed by writing it
    classes = materialize(
        sketches.where("n_shingles > 0")
        .groupBy("class")
        .agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    keys = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    members = materialize(_spread(keys, shared))
    names = classes.select("class", "node", "first")
    if not members.isEmpty():
        wanted = names.join(members.select("node").distinct(), "node", "left_semi")
        sets = materialize(_class_sets(texts.select("doc_id", "text"), sketches, wanted, shingle))
        labels = components(_links(sets, members, percent))
        named = names.join(labels, "node", "left").withColumn("whole", F.coalesce("component", "node"))
        smallest = named.groupBy("whole").agg(F.min("first").alias("component_id"))
        names = named.select("class", "whole").join(smallest, "whole")
    else:
        names = names.select("class", F.col("node").alias("whole"), F.col("first").alias("component_id"))
    return sketches, names


def _spread(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """`rows` joined with one row of `facts` per bucket; a bucket's rows are dealt to several tasks."""
    salted = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(_SALTS)).cast("int")).join(salted, ["bucket", "salt"]).drop("salt")


def _class_sets(texts: DataFrame, sketches: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the classes of `wanted` (class, node, first), each once.

    The texts stay where they are: tasks know the wanted ids by a filter of a fixed number of bits, and only the sets of
    ids it lets through move.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_BITS))
    several = materialize(sketches.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"))
    asked = wanted.select(F.col("first").alias("doc_id")).union(several).select((place + 1).alias("p"))
    words = asked.groupBy(F.bitmap_bucket_number("p").alias("word")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    marked = np.zeros(_BITS >> 3, np.uint8)
    for r in words.collect():  # _BITS / 2 ** 15 rows of 4 KB
        marked[(r.word - 1) << 12 : r.word << 12] = np.frombuffer(r.bits, np.uint8)
    found = texts.select("doc_id", place.alias("place"), "text").mapInArrow(
        _sets(shingle, marked), "doc_id long, class binary, shingles array<long>"
    )
    single = wanted.where("first is not null").select(F.col("first").alias("doc_id"), "node")
    if several.isEmpty():
        return found.join(single, "doc_id").select("node", "shingles")
    once = found.join(single.join(several, "doc_id", "left_anti"), "doc_id").select("node", "shingles")
    # rows of repeated and null ids stand for a class only if no other row does, and then once
    ids = several.withColumnRenamed("doc_id", "id")
    rest = wanted.join(ids, F.col("first").eqNullSafe(F.col("id")), "left_semi").select("class", "node")
    again = found.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").join(rest, "class")
    return once.unionByName(again.dropDuplicates(["node"]).select("node", "shingles"))


def _reaches(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether sets of n_a and n_b shingles with `common` shared ones reach the threshold."""
    return common * 100 >= (n_a + n_b - common) * percent


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common) of pairs (a, b) on full sets; the set of an `a` in many pairs travels in copies."""
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / _FAN).cast("int").alias("fan"))
    dealt = pairs.join(fan, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("fan")).cast("int")).drop("fan")
    left = sets.join(fan, F.col("node") == F.col("a")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"), F.col("shingles").alias("sa")
    )
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return dealt.join(right, "b").join(left, ["a", "salt"]).select(
        "a",
        "b",
        F.size("sa").cast("long").alias("n_a"),
        F.size("sb").cast("long").alias("n_b"),
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"),
    )


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where(_reaches(F.col("common"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _links(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) that join all candidates of `members` (bucket, node, n, held) that are linked."""
    central = members.groupBy("node").agg(F.sum("held").alias("central"))
    hubs = members.join(central, "node").groupBy("bucket").agg(F.max(F.struct("central", "node"))["node"].alias("hub"))
    pairs = _spread(members.drop("held"), hubs).where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    compared = materialize(_compared(pairs.distinct(), sets))
    links = _linked(compared, percent)
    group = compared.select(
        F.col("a").alias("hub"), F.col("b").alias("node"), F.col("n_b").alias("n"), F.col("n_a").alias("hub_n"), "common"
    )
    before = None
    while True:
        links = materialize(links)
        open_ = _open(group, components(links))
        if open_.isEmpty():
            return links
        adds = materialize(_adds(open_, sets))
        rare = _rare(adds, percent)
        sizes = _by_size(open_, percent)
        work = rare.groupBy("hub", "s", "component").count().groupBy("hub", "s").agg(
            F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("same")
        )
        seen = work.agg(F.sum("all").alias("rows"), F.sum((F.col("all") * F.col("all") - F.col("same")) / 2).alias("pairs")).first()
        count = (seen.pairs or 0) + sizes.count()
        if count <= _DENSE * ((seen.rows or 0) + 1000) or (before is not None and count > 0.7 * before):
            found = _by_adds(rare, percent).union(sizes).distinct()
            return links.union(_linked(_compared(found, sets), percent))
        before = count
        # a further hub for every open group: of its largest foreign component, the member whose additions most others share
        foreign = adds.where("component <> hub_component")
        mass = foreign.groupBy("hub", "component").agg(F.count("*").alias("c"), F.max(F.struct("shared", "node")).alias("m"))
        second = mass.groupBy("hub").agg(F.max(F.struct("c", "m", "component")).alias("top"))
        second = second.select("hub", F.col("top.m.node").alias("a"), F.col("top.component").alias("own"))
        more = open_.join(second, "hub").where("component <> own").select("a", F.col("node").alias("b"))
        links = links.union(_linked(_compared(more.distinct(), sets), percent))
        # compared with everyone in its group, it has nothing left to find there
        group = materialize(group.join(second.select("hub", F.col("a").alias("node")), ["hub", "node"], "left_anti"))


def _open(group: DataFrame, labels: DataFrame) -> DataFrame:
    """`group` with components, for the hubs whose members, the hub left out, lie in more than one."""
    mine = labels
    hubs = labels.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    placed = (
        group.join(mine, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(hubs, "hub", "left")
        .withColumn("hub_component", F.coalesce("hub_component", "hub"))
    )
    placed = materialize(placed)
    several = placed.groupBy("hub").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return materialize(placed.join(several.where("low <> high").select("hub"), "hub", "left_semi"))


def _adds(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """`open_` with `adds`: the shingles a member has beside the hub's and shares in its group, rarest first."""
    fan = open_.groupBy("hub").agg(F.ceil(F.count("*") / _FAN).cast("int").alias("fan"))
    dealt = open_.join(fan, "hub").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("fan")).cast("int"))
    whole = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("sh")).join(fan, "hub")
    whole = whole.select("hub", "sh", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"))
    added = dealt.join(sets, "node").join(whole, ["hub", "salt"]).select(
        "hub", "node", F.explode(F.array_except("shingles", "sh")).alias("s")
    )
    added = materialize(added)
    often = added.groupBy("hub", "s").agg(F.count("*").alias("c")).where("c > 1")
    # one list per member of a group, no longer than its own set
    lists = (
        added.join(often, ["hub", "s"])
        .groupBy("hub", "node")
        .agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("adds"), F.sum("c").alias("shared"))
    )
    return open_.join(lists, ["hub", "node"])


def _rare(adds: DataFrame, percent: int) -> DataFrame:
    """Rows (hub, s, ...) of the additions that a member must share one of with any partner it can be linked to."""
    missing = F.floor((F.col("n") * percent + 99) / 100) - F.col("common")
    length = F.size("adds") - F.greatest(F.lit(1), missing) + 1
    kept = adds.withColumn("a", F.size("adds")).where(length > 0)
    rows = kept.withColumn("add", F.explode(F.slice("adds", F.lit(1), length.cast("int"))))
    return rows.select("hub", F.col("add.s").alias("s"), "node", "n", "common", "a", "component")


def _pair(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _by_adds(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub that share an addition and whose bound reaches the threshold."""
    other = rare.select("hub", "s", *(F.col(c).alias(f"{c}_2") for c in ("node", "n", "common", "a", "component")))
    most = F.least("common", "common_2") + F.least("a", "a_2")
    return (
        rare.join(other, ["hub", "s"])
        .where((F.col("node") < F.col("node_2")) & (F.col("component") != F.col("component_2")))
        .where(_reaches(most, F.col("n"), F.col("n_2"), percent))
        .select(*_pair("node", "node_2"))
        .distinct()
    )


def _size_class(n: Column) -> Column:
    """Sizes up to 64 by themselves, larger ones in steps of a fiftieth."""
    return F.when(n <= 64, n).otherwise(64 + F.floor(F.log(n / 64.0) / math.log(1.02))).cast("int")


def _by_size(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub whose parts of the hub alone reach the threshold, one of them outside the hub's component.

    A member that has `common` shingles of the hub can only be linked so to partners of at most
    common * (100 + percent) / percent - n shingles.
    """
    cap = F.floor(F.col("common") * (100 + percent) / percent).cast("long") - F.col("n")
    low = F.floor((F.col("n") * percent + 99) / 100)
    high = F.least(cap, F.floor(F.col("n") * 100 / percent))
    outside = open_.where((F.col("component") != F.col("hub_component")) & (low <= high) & (low > 0))
    wanted = outside.withColumn("size", F.explode(F.sequence(_size_class(low), _size_class(high))))
    other = open_.select("hub", _size_class(F.col("n")).alias("size"), *(F.col(c).alias(f"{c}_2") for c in ("node", "n", "common", "component")))
    return (
        wanted.join(other, ["hub", "size"])
        .where(F.col("component") != F.col("component_2"))
        .where(_reaches(F.least("common", "common_2"), F.col("n"), F.col("n_2"), percent))
        .select(*_pair("node", "node_2"))
        .distinct()
    )
