"""Best matches between a frame of queries and a catalogue of names, without scoring every query with every name.

A fuzzy score is an equality, a containment, or made of word overlap and edit similarity. It reaches a bound only if the
word overlap or the edit similarity alone does: containment implies an edit similarity no smaller than its score,
and the mixed score is at most the larger of the two. So, with a bound b for a query's k-th best score,

* words: at most a share 1 - b of the query's words may be without a related word in the name, so a name that counts has
  a word related to one of the query's rarest ones, few enough to be looked up in an index of words;
* letters: at most d = (1 - b) * longest edits are allowed, and d edits leave one of d + 1 disjoint letter groups
  of the query in place, give or take d positions; the rarest groups are looked up in an index of groups.

The bound is the k-th best score among some names that share rare groups with the query, looked up first; a wrong choice
of these costs time, not results. Queries too short for d + 1 groups, since few names are like them, meet the names whose
length allows the bound, and a comparison of letter counts, then an edit distance that gives up after d edits, is all
that such a pair costs.

A semantic score needs a common word or equal texts. Names and queries with the same words are one set, and sets meet
on their rarest words (a prefix filter). All indexes are equi-joins, whose hot keys adaptive execution splits.
Where the queries fit in a broadcast of bounded size, names are scored as they are read instead, unless many have the same
words and meet many queries: only those that reach the threshold are shuffled, so a catalogue of long texts is never written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions import text as T
from almoner.operators.ranks import attach
from almoner.session import materialize, shuffles_freed

# letter groups of a query, and names per group, that are looked up to find a bound
RARE = 8
SEEDS = 32
# tasks the names of one length class are spread over
SPREAD = 16
# queries whose texts and index take at most so many bytes together are broadcast to the names; a word in the index takes 100
FEW_BYTES = 64_000_000
# more names than so many with the same words, on the average, are brought together before they are scored, unless a word
# meets few queries, so that scoring costs no more than taking the names apart
REPEATS = 8
FEW_MEETINGS = 16
_LEAST = 1e-9  # scores are sums of fractions; bounds are lowered by this much

Score = Callable[[Column, Column], Column]


def _distinct(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct non-empty texts, written once because they are counted and matched, or matched twice."""
    return materialize(df.select(F.col(column).alias(out)).where(F.length(out) > 0).distinct())


def _numbered(df: DataFrame, column: str, out: str, key: str, parts: Callable[[Column], Column]) -> DataFrame:
    """(key, out, parts) of the distinct non-empty texts; the number of a text is fixed by writing it."""
    texts = df.select(F.col(column).alias(out)).where(F.length(out) > 0).distinct()
    return materialize(texts.withColumn("parts", parts(F.col(out))).withColumn(key, F.monotonically_increasing_id()))


def _meet(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join by shuffles. Texts taken apart are many times what their files let Spark expect, too much to broadcast."""
    return left.join(right.hint("merge"), on, how)


def _grams(text: Column, size: Column | int) -> Column:
    """Array of (at, gram): all letter groups of one size, empty for shorter texts."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.struct(p.alias("at"), F.substring(text, p, size).alias("gram")))


def contained(whole: DataFrame, part: DataFrame) -> DataFrame:
    """(whole, part) of `whole` (whole, text) and `part` (part, text) where the whole's text contains the part's.

    A part is looked up by its rarest group of three letters, or by all of it if it is shorter. Empty parts are left out.
    """
    sized = F.flatten(F.array(*(_grams(F.col("text"), n) for n in (1, 2, 3))))
    index = whole.select("whole", F.explode(F.array_distinct(F.transform(sized, lambda g: g["gram"]))).alias("gram"))
    often = index.groupBy("gram").agg(F.count("*").alias("c"))
    own = part.select("part", F.explode(_grams(F.col("text"), F.least(F.length("text"), F.lit(3)))["gram"]).alias("gram"))
    rarest = _meet(own, often, "gram", "left").groupBy("part").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "gram"))["gram"].alias("gram")
    )
    met = _meet(_meet(_meet(index, rarest, "gram"), whole, "whole").withColumnRenamed("text", "long"), part, "part")
    return met.where(F.contains("long", "text")).select("whole", "part")


def _related(asked: DataFrame, held: DataFrame) -> DataFrame:
    """(a, b) of words (word) of both sides that are equal or of which one contains the other."""
    one = asked.select(F.col("word").alias("whole"), F.col("word").alias("text"))
    two = held.select(F.col("word").alias("whole"), F.col("word").alias("text"))
    over = contained(two, one.withColumnRenamed("whole", "part")).select(F.col("part").alias("a"), F.col("whole").alias("b"))
    under = contained(one, two.withColumnRenamed("whole", "part")).select(F.col("whole").alias("a"), F.col("part").alias("b"))
    return over.union(under).distinct()


def _first(rows: DataFrame, key: str, most: int, *order: str | Column) -> DataFrame:
    """The first `most` rows of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= most).drop("place")


def _top(scored: DataFrame, k: int) -> DataFrame:
    """Best k rows (query, name, score) of each query, by score and then by name."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "name")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "name", "score", "rank")


def _scored(pairs: DataFrame, asked: DataFrame, held: DataFrame, score: Score) -> DataFrame:
    """Pairs (qid, nid) with their texts and score."""
    left = asked.select("qid", "query", F.col("parts").alias("q"))
    right = held.select("nid", "name", F.col("parts").alias("n"))
    both = _meet(_meet(pairs, left, "qid"), right, "nid")
    return both.select("qid", "query", "name", score(F.col("q"), F.col("n")).alias("score"))


def _length_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.25))).cast("int")


def _letter_mask(text: Column) -> Column:
    """(low, high): per class of characters, of which there are 32, a bit for each of the first four that occur.

    A bit that one text has and the other lacks takes an edit, so the bits tell most unlike texts apart at no cost.
    """
    grow = lambda bits, at: bits.bitwiseOR(
        F.call_function("shiftleft", F.call_function("shiftrightunsigned", bits, at).bitwiseAND(F.lit(7)) * 2 + 1, at)
    )

    def add(acc: Column, code: Column) -> Column:
        at = (code % 16) * 4
        upper = code >= 16
        low, high = F.when(upper, acc["low"]).otherwise(grow(acc["low"], at)), F.when(upper, grow(acc["high"], at)).otherwise(acc["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: (F.ascii(c) % 32).cast("int"))
    none = F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    return F.aggregate(codes, none, add)


def _bits_beside(a: str, b: str) -> Column:
    """Bits of mask `a` that mask `b` lacks."""
    lacks = [F.bit_count(F.col(f"{a}.{half}").bitwiseAND(F.bitwise_not(f"{b}.{half}"))) for half in ("low", "high")]
    return lacks[0] + lacks[1]


def fuzzy_candidates(asked: DataFrame, held: DataFrame, threshold: float, k: int) -> DataFrame:
    """Pairs (qid, nid) that hold the best k names of every query."""
    words = asked.select("qid", F.posexplode("parts.words").alias("at", "word"))
    postings = materialize(held.select("nid", F.explode(F.array_distinct("parts.words")).alias("word")))
    often = postings.groupBy("word").agg(F.count("*").alias("c"))
    related = materialize(_related(words.select("word").distinct(), often.select("word")))
    # the index of letter groups, with the length of the name
    text, size = F.col("parts.text"), F.length("parts.text")
    groups = held.select("nid", size.alias("n_len"), F.explode(F.flatten(F.array(_grams(text, 3), _grams(text, 2)))).alias("g"))
    groups = materialize(groups.select("nid", "n_len", F.col("g.at").alias("n_at"), F.col("g.gram").alias("gram")))
    counts = groups.groupBy("gram").agg(F.count("*").alias("c"))
    own = asked.select("qid", size.alias("q_len"), F.explode(F.flatten(F.array(_grams(text, 3), _grams(text, 2)))).alias("g"))
    own = own.select("qid", "q_len", F.col("g.at").alias("at"), F.col("g.gram").alias("gram"))
    own = materialize(_meet(own, counts, "gram", "left").withColumn("c", F.coalesce("c", F.lit(0))))

    # some names that share rare groups, for a bound
    rare = _first(own.where("c > 0").select("qid", "gram", "c").distinct(), "qid", RARE, "c", "gram")
    some = _meet(rare, _first(groups.select("gram", "nid").distinct(), "gram", SEEDS, "nid"), "gram").select("qid", "nid")
    tried = _scored(some.distinct(), asked, held, T.fuzzy_score_parts)
    kth = _first(tried, "qid", k, F.desc("score"), "name").groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    bound = F.greatest(F.lit(threshold), F.when(F.col("n") >= k, F.col("low"))) - _LEAST
    facts = asked.select("qid", size.alias("q_len"), F.size("parts.words").alias("n_words"))
    facts = _meet(facts, kth, "qid", "left").select("qid", "q_len", "n_words", bound.alias("bound"))
    edits = F.floor((1 - F.col("bound")) * F.floor(F.col("q_len") / F.col("bound"))).cast("int")
    facts = facts.withColumn("edits", edits)

    # letters: disjoint rare groups of three, else of two
    def chosen(size: int) -> Column:
        sized = F.sort_array(F.filter("groups", lambda g: F.length(g["gram"]) == size))
        none = F.array().cast("array<struct<c:bigint,at:int,gram:string>>")
        free = lambda acc, g: ~F.exists(acc, lambda x: F.abs(x["at"] - g["at"]) < size)
        take = lambda acc, g: F.when((F.size(acc) <= F.col("edits")) & free(acc, g), F.concat(acc, F.array(g))).otherwise(acc)
        return F.aggregate(sized, none, take)

    lists = own.groupBy("qid").agg(F.collect_list(F.struct("c", "at", "gram")).alias("groups"))  # of one query's text
    picked = _meet(facts, lists, "qid", "left").withColumns({"three": chosen(3), "two": chosen(2)})
    enough = F.when(F.size("three") > F.col("edits"), F.col("three")).when(F.size("two") > F.col("edits"), F.col("two"))
    picked = materialize(picked.withColumn("use", enough).drop("groups", "three", "two"))
    keys = picked.withColumn("g", F.explode("use")).select("qid", "q_len", "bound", "edits", F.col("g.at").alias("at"), F.col("g.gram").alias("gram"))
    close = F.abs(F.col("at") - F.col("n_at")) <= F.col("edits")
    long = (F.col("n_len") >= F.col("bound") * F.col("q_len")) & (F.col("n_len") * F.col("bound") <= F.col("q_len"))
    spelt = _meet(keys, groups, "gram").where(close & long).select("qid", "nid")

    # queries too short for that: all names of a fitting length, a length class dealt to several tasks
    short = _meet(picked.where("use is null"), asked.select("qid", text.alias("q_text"), _letter_mask(text).alias("q_mask")), "qid")
    low, high = _length_class(F.ceil(F.col("bound") * F.col("q_len"))), _length_class(F.floor(F.col("q_len") / F.col("bound")))
    dealt = short.withColumn("size", F.explode(F.sequence(low, high))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    sized = held.select("nid", text.alias("n_text"), _letter_mask(text).alias("n_mask"), size.alias("n_len"), F.pmod("nid", F.lit(SPREAD)).cast("int").alias("salt"))
    # few bytes but much work: a given number of tasks is not merged into fewer
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = sized.withColumn("size", _length_class(F.col("n_len"))).repartition(tasks, "size", "salt")
    most = F.floor((1 - F.col("bound")) * F.greatest("q_len", "n_len")).cast("int")
    able = long & (F.greatest(_bits_beside("q_mask", "n_mask"), _bits_beside("n_mask", "q_mask")) <= most)
    alike = _meet(dealt, sized, ["size", "salt"]).where(able & (F.call_function("levenshtein", F.col("q_text"), F.col("n_text"), most) >= 0))

    # words: of the query's places, the rarest that cannot all be without a related word
    reach = _meet(related, often, related.b == often.word).groupBy("a").agg(F.sum("c").alias("c"))
    placed = _meet(_meet(words, reach, F.col("word") == F.col("a"), "left"), picked.drop("use"), "qid")
    spare = F.col("n_words") - F.ceil(F.col("bound") * F.col("n_words")) + 1
    order = Window.partitionBy("qid").orderBy(F.coalesce("c", F.lit(0)), "word", "at")
    looked = placed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= spare).select("qid", "word").distinct()
    found = _meet(looked, related, F.col("word") == F.col("a")).select("qid", "b")
    found = _meet(found, postings, F.col("b") == F.col("word")).select("qid", "nid")
    return found.union(spelt).union(alike.select("qid", "nid")).distinct()


def fuzzy_join(
    queries: DataFrame,
    names: DataFrame,
    threshold: float = 0.3,
    k: int = 10,
    query: str = "query",
    name: str = "name",
    case_sensitive: bool = False,
) -> DataFrame:
    """Best k names per query by fuzzy score; equal scores are ordered by name."""
    parts = lambda c: T.fuzzy_parts(c, case_sensitive)
    asked, held = _numbered(queries, query, "query", "qid", parts), _numbered(names, name, "name", "nid", parts)
    pairs = fuzzy_candidates(asked, held, threshold, k)
    return _top(_scored(pairs, asked, held, T.fuzzy_score_parts).where(F.col("score") >= threshold), k)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _word_sets(texts: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(text, key), and (id, key, words) of the distinct sets of words; texts without words have no set.

    A set is written as one string, less than its array takes, and found by the digest of that, so that no text moves for it.
    """
    line = "\n"  # in no word
    joined = F.array_join(F.sort_array("parts.words"), line)
    sets = materialize(texts.select(joined.alias("joined")).distinct().withColumn("id", F.monotonically_increasing_id()))
    split = sets.where("joined <> ''").select("id", _digest(F.col("joined")).alias("key"), F.split("joined", line).alias("words"))
    return texts.select(text, _digest(joined).alias("key")), split


def _fits(size: Column, low: Column, high: Column, threshold: float) -> Column:
    """Whether a set can reach the threshold with one of low to high words: a score is at most the smaller size by the larger."""
    return (size >= threshold * low - _LEAST) & (size * threshold <= high + _LEAST)


def _reaches(common: Column, both: Column, threshold: float) -> Column:
    """Whether two sets of so many words together reach the threshold with so many in common."""
    return common >= threshold * (both - common) - _LEAST


def _prefixes(sets: DataFrame, often: DataFrame, threshold: float, key: str) -> DataFrame:
    """The rarest words of each set, one of which a partner must share, and how many words that are known come after each.

    `often` counts the words that both sides have. Others cannot be shared, but count for a set's size.
    """
    rows = sets.select("id", F.size("words").alias("size"), F.explode("words").alias("word"))
    rows = _meet(rows, often.select("word", "c"), "word")
    one = Window.partitionBy("id")
    rest = F.count("*").over(one) - F.row_number().over(one.orderBy("c", "word"))
    needed = F.ceil(F.col("size") * threshold - _LEAST)
    placed = rows.withColumn("rest", rest).where(F.col("rest") + 1 >= needed)
    return placed.select("word", F.col("id").alias(key), F.col("size").alias(f"{key}_size"), F.col("rest").alias(f"{key}_rest"))


def _shared(x: Column, y: Column) -> Column:
    """Shared part of two sets of words."""
    return T._let(F.size(F.array_intersect(x, y)), lambda common: common / (F.size(x) + F.size(y) - common))


def semantic_pairs(asked: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """(a, b, score) of sets of words (id, words) whose shared part reaches a threshold above 0."""
    # sets beyond these sizes meet nobody and are not taken apart
    size = F.size("words")
    sizes = attach(held, asked.agg(F.min(size).alias("low"), F.max(size).alias("high")), "__sizes")
    held = sizes.where(_fits(size, F.col("__sizes")["low"], F.col("__sizes")["high"], threshold)).drop("__sizes")
    often = held.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("c"))
    often = _meet(often, asked.select(F.explode("words").alias("word")).distinct(), "word")

    # what can follow the first common word bounds what two sets share
    most = 1 + F.least("a_rest", "b_rest")
    met = _meet(_prefixes(asked, often, threshold, "a"), _prefixes(held, often, threshold, "b"), "word")
    pairs = materialize(met.where(_reaches(most, F.col("a_size") + F.col("b_size"), threshold)).select("a", "b").distinct())
    left, right = asked.select(F.col("id").alias("a"), F.col("words").alias("x")), held.select(F.col("id").alias("b"), F.col("words").alias("y"))
    scored = _meet(_meet(pairs, left, "a"), right, "b").select("a", "b", _shared(F.col("x"), F.col("y")).alias("score"))
    return scored.where(F.col("score") >= threshold)


def _scored_in_place(sets: DataFrame, held: DataFrame, threshold: float, k: int) -> DataFrame | None:
    """(a, name, score): best k of `held` (name, words) for each set of words (id, words), where these fit in a broadcast.

    Names are scored in the task that reads them. None if that would score many names with the same words over and over.
    """
    # explode_outer, since Spark would take the texts apart again to leave out empty ones before explode
    mark = F.lit("")  # no word; one row of it for each name
    known = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("asked"))
    known = F.broadcast(known.union(sets.select(mark, F.lit(0)).distinct()))
    sized = held.select("words", F.xxhash64("words").alias("own"), F.size("words").alias("size"))
    marked = sized.select("own", "size", F.explode_outer(F.concat(F.array(mark), "words")).alias("word")).join(known, "word")
    counts = F.count("*").alias("c"), F.approx_count_distinct("own").alias("own"), F.sum("size").alias("words")
    often = materialize(marked.groupBy("word", "asked").agg(*counts))
    of_all = (F.max(F.when(F.col("word") == mark, F.col(x))).alias(x) for x in ("c", "own", "words"))
    seen = often.agg(F.sum(F.col("c") * F.col("asked")).alias("met"), *of_all).first()
    if seen["c"] and seen["c"] > REPEATS * seen["own"] and seen["met"] > FEW_MEETINGS * seen["words"]:
        return None

    rows = held.select("name", "words", F.explode_outer("words").alias("word"))
    met = rows.join(F.broadcast(_prefixes(sets, often, threshold, "a")), "word")
    most = F.least(1 + F.col("a_rest"), F.size("words"))
    able = met.where(_reaches(most, F.col("a_size") + F.size("words"), threshold))
    both = able.join(F.broadcast(sets.select(F.col("id").alias("a"), F.col("words").alias("x"))), "a")
    scored = both.select("a", "name", _shared(F.col("x"), F.col("words")).alias("score")).where(F.col("score") >= threshold)
    return _first(scored.distinct(), "a", k, F.desc("score"), "name")


def _scored_by_sets(sets: DataFrame, held: DataFrame, threshold: float, k: int) -> DataFrame:
    """(a, name, score): best k of `held` (name, words) for each set of words (id, words); names with the same words are scored once."""
    with shuffles_freed(held.sparkSession):
        n_keys, n_sets = _word_sets(held.select("name", F.struct("words").alias("parts")), "name")
        pairs = materialize(semantic_pairs(sets, n_sets, threshold))
        found = _meet(n_sets.select("id", "key"), pairs.select(F.col("b").alias("id")), "id", "left_semi")
        # of a set's names the first k can be wanted, and of a query's sets the first k
        named = _meet(n_keys, found, "key").select("id", "name").distinct()
        firsts = materialize(_first(named, "id", k, "name"))
    heads = firsts.groupBy("id").agg(F.min("name").alias("head"))
    near = _first(_meet(pairs, heads, F.col("b") == F.col("id")).drop("id"), "a", k, F.desc("score"), "head")
    per_set = _meet(near, firsts, F.col("b") == F.col("id")).select("a", "name", "score")
    return _first(per_set, "a", k, F.desc("score"), "name")


def semantic_join(
    queries: DataFrame,
    names: DataFrame,
    threshold: float = 0.1,
    k: int = 10,
    query: str = "query",
    name: str = "name",
) -> DataFrame:
    """Best k names per query by shared meaning; equal scores are ordered by name. The threshold must be above 0."""
    if threshold <= 0:
        raise ValueError("names that share nothing with a query have no order; the threshold must be above 0")
    asked = _distinct(queries, query, "query")
    q_keys, q_sets = _word_sets(asked.withColumn("parts", T.semantic_parts(F.col("query"))), "query")
    size, texts = F.size("words"), asked.agg(F.sum(F.octet_length("query"))).first()[0] or 0
    words, low, high = (x or 0 for x in q_sets.agg(F.sum(size), F.min(size), F.max(size)).first())
    fits = lambda w: F.when(_fits(F.size(w), F.lit(low), F.lit(high), threshold), w)
    some = names.select(F.col(name).alias("name")).where(F.length("name") > 0)
    held = some.select("name", T._let(T.semantic_parts(F.col("name"))["words"], fits).alias("words"))
    few = 2 * texts + 100 * words <= FEW_BYTES
    per_set = _scored_in_place(q_sets, held, threshold, k) if few else None
    if per_set is None:
        per_set = _scored_by_sets(q_sets, held, threshold, k)
    if few:
        same = some.withColumn("t", F.lower("name")).join(F.broadcast(asked.withColumn("t", F.lower("query"))), "t")
    else:
        same = _meet(some.withColumn("t", _digest(F.lower("name"))), asked.withColumn("t", _digest(F.lower("query"))), "t")
        same = same.where(F.lower("query") == F.lower("name"))
    per_key = _meet(per_set, q_sets.select(F.col("id").alias("a"), "key"), "a").select("key", "name", "score")
    alike = _meet(q_keys, per_key, "key").select("query", "name", "score")
    same = same.select("query", "name", F.lit(1.0).alias("score"))
    return _top(alike.union(same).groupBy("query", "name").agg(F.max("score").alias("score")), k)


def combined_join(
    queries: DataFrame,
    names: DataFrame,
    fuzzy_threshold: float = 0.3,
    semantic_threshold: float = 0.1,
    k: int = 10,
    combine: bool = True,
    query: str = "query",
    name: str = "name",
) -> DataFrame:
    """Top 2k of both kinds merged; the score is 0.7 fuzzy + 0.3 semantic, or the larger one."""
    queries, names = _distinct(queries, query, "query"), _distinct(names, name, "name")
    fuzzy = fuzzy_join(queries, names, fuzzy_threshold, 2 * k).select(
        "query", "name", F.col("score").alias("f"), F.col("rank").alias("f_rank")
    )
    semantic = semantic_join(queries, names, semantic_threshold, 2 * k).select(
        "query", "name", F.col("score").alias("s"), F.col("rank").alias("s_rank")
    )
    f, s = F.coalesce("f", F.lit(0.0)), F.coalesce("s", F.lit(0.0))
    kind = F.when(F.col("s").isNull(), "fuzzy").when(F.col("f").isNull(), "semantic")
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.asc_nulls_last("f_rank"), F.asc("s_rank")
    )
    return (
        _meet(fuzzy, semantic, ["query", "name"], "full_outer")
        .withColumn("score", f * 0.7 + s * 0.3 if combine else F.greatest(f, s))
        .withColumn("match_type", kind.otherwise("combined"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query", "name", "score", "match_type", "rank")
    )


def suggest(
    queries: DataFrame, names: DataFrame, query: str = "query", name: str = "name"
) -> DataFrame:
    """Up to five corrections per query with a fuzzy score of at least 0.4."""
    return fuzzy_join(queries, names, 0.4, 5, query, name)


def suggest_two_lists(
    queries: DataFrame, names: DataFrame, k: int = 5, query: str = "query", name: str = "name"
) -> DataFrame:
    """Fuzzy suggestions, then semantic suggestions that the fuzzy list does not already hold."""
    queries, names = _distinct(queries, query, "query"), _distinct(names, name, "name")
    fuzzy = materialize(fuzzy_join(queries, names, 0.3, k).withColumn("kind", F.lit("fuzzy")))
    semantic = semantic_join(queries, names, 0.1, k).withColumn("kind", F.lit("semantic"))
    return fuzzy.unionByName(_meet(semantic, fuzzy, ["query", "name"], "left_anti"))


def search_fields(
    custom_fields: DataFrame,
    queries: DataFrame,
    kind: str = "fuzzy",
    threshold: float | None = None,
    k: int = 10,
    query: str = "query",
) -> DataFrame:
    """Matching custom fields with their metadata row."""
    if kind not in ("fuzzy", "semantic"):
        raise ValueError(f"kind must be fuzzy or semantic, not {kind!r}")
    join = fuzzy_join if kind == "fuzzy" else semantic_join
    default = 0.3 if kind == "fuzzy" else 0.1
    found = join(queries, custom_fields, default if threshold is None else threshold, k, query)
    return _meet(found, custom_fields, "name")


def suggest_mapped(
    queries: DataFrame,
    names: DataFrame,
    display_to_api: dict[str, str],
    k: int = 5,
    query: str = "query",
    name: str = "name",
) -> DataFrame:
    """Exact renamings both ways first, then names containing or contained in the query.

    Spaces, underscores and case do not count in the containment test.
    """
    to_api = F.create_map(*[F.lit(x) for pair in display_to_api.items() for x in pair])
    to_display: dict[str, str] = {}
    for display, api in display_to_api.items():
        to_display.setdefault(api, display)
    back = F.create_map(*[F.lit(x) for pair in to_display.items() for x in pair])

    def parts(c: Column) -> Column:
        api = F.coalesce(F.try_element_at(to_api, c), c)
        display = F.coalesce(F.try_element_at(back, c), c)
        again = F.coalesce(F.try_element_at(to_api, display), display)
        return F.struct(
            F.translate(F.lower(c), " _", "").alias("text"),
            F.when(api != c, api).alias("api"),
            F.when(display != c, again).alias("again"),
        )

    asked, held = _numbered(queries, query, "query", "qid", parts), _numbered(names, name, "name", "nid", parts)
    exact = [
        _meet(asked, held.select("name"), F.col(f"parts.{column}") == F.col("name")).select("query", "name", F.lit(score).alias("score"))
        for column, score in (("api", 3.0), ("again", 2.0))
    ]
    q = asked.select(F.col("qid").alias("id"), F.col("parts.text").alias("text"))
    n = held.select(F.col("nid").alias("id"), F.col("parts.text").alias("text"))
    over = contained(n.withColumnRenamed("id", "whole"), q.withColumnRenamed("id", "part"))
    under = contained(q.withColumnRenamed("id", "whole"), n.withColumnRenamed("id", "part"))
    pairs = over.select(F.col("part").alias("qid"), F.col("whole").alias("nid")).union(
        under.select(F.col("whole").alias("qid"), F.col("part").alias("nid"))
    )
    near = _meet(_meet(pairs.distinct(), asked.select("qid", "query"), "qid"), held.select("nid", "name"), "nid")
    # a text of separators alone is contained in every other; the first k names are all it can add
    blank = F.col("parts.text") == ""
    everything = held.select("name").orderBy("name").limit(k)
    nothing = held.where(blank).select("name").orderBy("name").limit(k)
    any_ = asked.where(blank).select("query", F.explode(F.array(F.lit(0))).alias("one")).join(
        F.broadcast(everything.withColumn("one", F.lit(0))), "one"
    ).union(asked.select("query", F.lit(0).alias("one")).join(F.broadcast(nothing.withColumn("one", F.lit(0))), "one"))
    loose = near.select("query", "name").union(any_.select("query", "name")).withColumn("score", F.lit(1.0))
    scored = exact[0].union(exact[1]).union(loose)
    return _top(scored.groupBy("query", "name").agg(F.max("score").alias("score")), k)


def accept_field(
    queries: DataFrame,
    static_names: DataFrame,
    dynamic_names: DataFrame,
    query: str = "query",
    name: str = "name",
) -> DataFrame:
    """First way a field name is accepted: id, static, dynamic, fuzzy >= 0.7, semantic >= 0.3.

    Each stage only scores the names that every stage before it left over.
    """
    asked = queries.select(F.col(query).alias("query")).where(F.length("query") > 0).distinct()
    static = static_names.select(F.col(name).alias("query")).distinct().withColumn("st", F.lit(1))
    dynamic = dynamic_names.select(F.col(name).alias("query")).distinct().withColumn("dy", F.lit(1))
    how = (
        F.when(F.col("query").rlike(r"^\d+$"), "custom_id")
        .when(F.col("st").isNotNull(), "static")
        .when(F.col("dy").isNotNull(), "dynamic")
    )
    exact = materialize(
        _meet(_meet(asked, static, "query", "left"), dynamic, "query", "left")
        .select("query", how.alias("accepted_by"), F.when(how.isNotNull(), F.col("query")).alias("field"))
    )
    every = static_names.select(name).union(dynamic_names.select(name)).distinct()

    def stage(rest: DataFrame, join: Callable[..., DataFrame], threshold: float, label: str) -> DataFrame:
        found = join(rest, every, threshold, 1, "query", name)
        return materialize(found.select("query", F.lit(label).alias("accepted_by"), F.col("name").alias("field")))

    pending = exact.where(F.col("accepted_by").isNull()).select("query")
    near = stage(pending, fuzzy_join, 0.7, "fuzzy")
    pending = _meet(pending, near, "query", "left_anti")
    like = stage(pending, semantic_join, 0.3, "semantic")
    none = F.lit(None).cast("string").alias("field")
    rejected = _meet(pending, like, "query", "left_anti").select("query", F.lit("rejected").alias("accepted_by"), none)
    accepted = exact.where(F.col("accepted_by").isNotNull())
    return accepted.unionByName(near).unionByName(like).unionByName(rejected)
