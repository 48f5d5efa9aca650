"""Scalar rules, predicates and name scores on hand-made edge values."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from almoner.functions import scalars as S
from almoner.functions import text as T
from almoner.functions.predicates import predicate
from almoner.operators import aggregates as A
from almoner.operators import matching as M
from almoner.operators import quality as D
from almoner.operators.quality import FieldMeta


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["o"] for r in df.select("i", expression(F.col("c")).alias("o")).orderBy("i").collect()]


def test_predicates_keep_nulls_in_complements(spark):
    values = ["Ab%", "b_", "", " ", None]
    keep = lambda op, v=None: [bool(x) for x in one(spark, values, "string", lambda c: predicate(c, op, v))]
    assert keep("NOT_EQUAL", "b_") == [True, False, True, True, True]
    assert keep("NOT_IN_RANGE", ["", " "]) == [True, True, False, False, True]
    assert keep("NOT_CONTAIN", "B") == [False, False, True, True, True]
    assert keep("CONTAIN", "%") == [True, False, False, False, False]
    assert keep("BLANK") == [False, False, True, True, True]
    with pytest.raises(ValueError):
        predicate(F.col("c"), "LIKE", "x")
    with pytest.raises(ValueError):
        predicate(F.col("c"), "EQUAL")


def test_multivalue_and_numbers(spark):
    assert one(spark, ["a|b, c", "a,b", "|", "", None], "string", S.parse_multivalue) == [["a", "b, c"], ["a", "b"], [], [], []]
    assert one(spark, ["$1,234.5", "12%", "x", "", "1d", "nan"], "string", S.clean_number) == [1234.5, 12.0, None, None, None, None]
    assert one(spark, ["1.9", "", "x", None], "string", lambda c: S.parse_number(c, True)) == [1, 0, 0, 0]
    assert one(spark, ["TRUE", "On", "no", None], "string", S.parse_bool) == [True, True, False, False]


def test_dates(spark):
    values = ["2023-12-25", "12/25/2023", "25/12/2023", "2023-02-31", "15:30", "2023-12-25T01:02:03", "x"]
    got = one(spark, values, "string", S.parse_date)
    day = datetime(2023, 12, 25)
    assert got[:3] == [day, day, day]
    assert got[3] is None and got[6] is None
    assert got[5] == datetime(2023, 12, 25, 1, 2, 3)
    assert (got[4].hour, got[4].minute) == (15, 30)
    loose = ["2023-02-31", "1899-01-01", "1900-1-1", "2023-13-01", "2023-01", "x-y-z"]
    assert one(spark, loose, "string", S.loose_date_ok) == [True, False, True, False, False, False]


def test_days_are_floored(spark):
    as_of = datetime(2024, 1, 31, 12)
    values = [datetime(2024, 1, 31, 12), datetime(2024, 1, 31, 12, 0, 1), datetime(2024, 1, 30, 13), datetime(2024, 2, 1, 12)]
    assert one(spark, values, "timestamp_ntz", lambda c: S.days_since(c, as_of)) == [0, -1, 0, -1]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_score(a, b):
    a, b = a.lower(), b.lower()
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    ratio = min(len(a), len(b)) / max(len(a), len(b))
    if a.startswith(b) or b.startswith(a):
        return 0.9 * ratio
    if a in b or b in a:
        return 0.8 * ratio
    words = [[w for w in re.split(r"[_\-\s]+", t) if w] for t in (a, b)]
    total = 0.0
    for x in words[0]:
        for y in words[1]:
            weight = 1 if x == y else 0.8 if x.startswith(y) or y.startswith(x) else 0.6 if x in y or y in x else 0
            if weight:
                total += weight
                break
    w = total / max(map(len, words)) if all(words) else 0.0
    near = 1 - lev(a, b) / max(len(a), len(b))
    return max(w * 0.7 + near * 0.3, w, near)


NAMES = ["first_name", "firstName", "lastName", "Email 1", "email", "volunteer_activities", "phone-number", "vol act", "x", "", "amount"]


def test_fuzzy_score_equals_plain_python(spark):
    pairs = [(a, b) for a in NAMES for b in NAMES]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", T.fuzzy_score(F.col("a"), F.col("b")).alias("s")).collect():
        assert r["s"] == pytest.approx(plain_score(r["a"], r["b"]), abs=1e-12), (r["a"], r["b"])


def test_semantic_score(spark):
    df = spark.createDataFrame([("Gift", "donation"), ("phone", "PHONE"), ("a", "the"), ("zebra", "amount")], "a string, b string")
    got = [r[0] for r in df.select(T.semantic_score(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[1] == 1.0 and got[2] == 0.0 and got[3] == 0.0


@pytest.mark.parametrize("seeds", [1, 32])
def test_fuzzy_join_is_exact_for_any_bound(spark, monkeypatch, seeds):
    monkeypatch.setattr(M, "SEEDS", seeds)
    queries = spark.createDataFrame([(n,) for n in NAMES * 3], "query string")
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {(r["query"], r["name"], r["rank"]) for r in M.fuzzy_join(queries, names, 0.3, 4).collect()}
    want = set()
    for q in NAMES:
        if not q:
            continue
        ranked = sorted((-plain_score(q, n), n) for n in NAMES if n and plain_score(q, n) >= 0.3)
        want |= {(q, n, i + 1) for i, (_, n) in enumerate(ranked[:4])}
    assert got == want


def random_names(seed, count):
    draw = random.Random(seed)
    parts = ["ba", "co", "di", "fu", "ga", "he", "li", "mo", "nu", "pa", "re", "si", "ta", "vo", "é", "st"]
    words = ["".join(draw.choices(parts, k=draw.randint(2, 5))) for _ in range(300)]
    names = [draw.choice([" ", "_", "-"]).join(draw.choices(words, k=draw.randint(1, 4))) for _ in range(count)]
    asked = []
    for name in names[: count // 6]:
        letters = list(name)
        for _ in range(draw.randint(0, 3)):
            letters[draw.randrange(len(letters))] = draw.choice("abstu ")
        asked.append("".join(letters))
    return sorted(set(names)), sorted(set(asked) | {"x", "-", "zzzzzz", "Ba", names[0].upper(), " ".join(words[:30])})


def test_fuzzy_join_of_many_names_scores_few_pairs(spark):
    """The best names of all pairs, found among a small part of them."""
    names, asked = random_names(3, 900)
    held, queries = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(q,) for q in asked], "query string")
    pairs = queries.crossJoin(held).withColumn("score", T.fuzzy_score(F.col("query"), F.col("name"))).where("score >= 0.3")
    want = sorted(map(tuple, M._top(pairs, 5).collect()))
    assert sorted(map(tuple, M.fuzzy_join(queries, held, 0.3, 5).collect())) == want
    parts = lambda c: T.fuzzy_parts(c, False)
    numbered = M._numbered(queries, "query", "query", "qid", parts), M._numbered(held, "name", "name", "nid", parts)
    assert M.fuzzy_candidates(*numbered, 0.3, 5).count() < 0.15 * len(names) * len(asked)


def test_semantic_join_of_many_names_scores_few_pairs(spark):
    draw = random.Random(4)
    words = [f"{a}{b}" for a in ("gift", "date", "phone", "status", "addr", "zebra", "orchid", "violet") for b in ("", "qua", "lor", "mip", "tez", "vun")]
    names = sorted({draw.choice([" ", "_", "."]).join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(600)} | {"the", "AB", "ab", "phoneDate"})
    asked = sorted(set(draw.sample(names, 80)) | {"PHONEDATE", "aB", "of", "nothing alike"})
    held, queries = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(q,) for q in asked], "query string")
    pairs = queries.crossJoin(held).withColumn("score", T.semantic_score(F.col("query"), F.col("name")))
    for threshold in (0.1, 0.5):
        want = sorted(map(tuple, M._top(pairs.where(F.col("score") >= threshold), 7).collect()))
        assert sorted(map(tuple, M.semantic_join(queries, held, threshold, 7).collect())) == want
    numbered = M._numbered(queries, "query", "query", "qid", T.semantic_parts), M._numbered(held, "name", "name", "nid", T.semantic_parts)
    sets = [M._word_sets(x, c)[1] for x, c in zip(numbered, ("query", "name"))]
    assert M.semantic_pairs(*sets, 0.5).count() < 0.1 * len(names) * len(asked)
    with pytest.raises(ValueError):
        M.semantic_join(queries, held, 0.0)


def test_suggest_mapped_finds_containment_both_ways(spark):
    names = ["gift amount", "Gift_Amount total", "amount", "_", "phone", "a", "Account", "account name", "id"]
    asked = ["giftamount", "the gift amount total of it", "AMOUNT", " _", "ACC", "xyz", "Donor", "Account", "a"]
    mapping = {"Donor": "phone", "Account": "account name", "other": "a"}
    back = {v: k for k, v in mapping.items()}
    flat = lambda t: t.lower().replace(" ", "").replace("_", "")
    want = set()
    for q in asked:
        api, display = mapping.get(q, q), back.get(q, q)
        again = mapping.get(display, display)
        rows = []
        for n in names:
            score = 3.0 if api != q and n == api else 2.0 if display != q and n == again else 1.0 if flat(q) in flat(n) or flat(n) in flat(q) else 0.0
            rows += [(-score, n)] if score else []
        want |= {(q, n, -s, i + 1) for i, (s, n) in enumerate(sorted(rows)[:3])}
    got = M.suggest_mapped(spark.createDataFrame([(q,) for q in asked], "query string"), spark.createDataFrame([(n,) for n in names], "name string"), mapping, 3)
    assert set(map(tuple, got.collect())) == want


def test_gift_ranges_leave_gaps(spark, rows):
    amounts = [0, 0.5, 1, 50, 50.5, 51, 250, 5000, 5000.01]
    df = spark.createDataFrame([(float(a),) for a in amounts], "amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = dict(rows(A.gift_buckets(df)))
    assert got == {"$1-50": 51.0, "$51-250": 301.0, "$251-1000": 0.0, "$1001-5000": 5000.0, "$5000+": 5000.01}


def test_field_rules_at_their_limits(spark, rows):
    meta = [
        FieldMeta("mail", "Email"),
        FieldMeta("text", "Text", required=True),
        FieldMeta("pct", "Percentage"),
        FieldMeta("day", "Date"),
        FieldMeta("url", "URL"),
    ]
    local = "a" * 242
    df = spark.createDataFrame(
        [
            (1, f"{local}@example.org", "x" * 10000, "100", "1900-01-01", "http://localhost:80/x"),
            (2, f"{local}b@example.org", "x" * 10001, "101", "1899-12-31", "http://a.org/" + "x" * 2000),
            (3, "no", "", "-1", "2023-02-31", "ftp://a.org"),
            (4, None, None, "ten", "", None),
        ],
        "id int, mail string, text string, pct string, day string, url string",
    )
    assert rows(D.validate_fields(df, meta, "id"), "id", "field", "code") == [
        (2, "day", "old_date"),
        (2, "mail", "too_long"),
        (2, "pct", "range_warning"),
        (2, "text", "max_length"),
        (2, "url", "very_long"),
        (3, "day", "invalid_format"),
        (3, "mail", "invalid_format"),
        (3, "pct", "range_warning"),
        (3, "text", "required"),
        (3, "url", "invalid_format"),
        (4, "pct", "invalid_format"),
        (4, "text", "required"),
    ]
    summary = D.validation_summary(df, meta).first()
    assert (summary["total_fields"], summary["invalid_fields"], summary["overall_valid"]) == (20, 8, False)


def test_semantic_sets_of_impossible_size_are_left_out(spark):
    """Sizes that no set can match are dropped before they are taken apart; those right at the threshold stay."""
    from almoner.operators import matching as M

    asked = spark.createDataFrame([(1, [f"w{i}" for i in range(2)]), (2, [f"w{i}" for i in range(4)])], "id bigint, words array<string>")
    sizes = (1, 2, 8, 9, 400)
    held = spark.createDataFrame([(n, [f"w{i}" for i in range(n)]) for n in sizes], "id bigint, words array<string>")
    found = M.semantic_pairs(asked, held, 0.5)
    want = {(a, n): min(k, n) / max(k, n) for a, k in ((1, 2), (2, 4)) for n in sizes if min(k, n) / max(k, n) >= 0.5}
    assert {(r.a, r.b): r.score for r in found.collect()} == want
    assert "scalar-subquery" in found._jdf.queryExecution().analyzed().toString()


def long_texts():
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 5))) for _ in range(400)] + ["gift", "date", "phoneDate", "of"]
    asked = [" ".join(draw.choices(words, k=draw.randint(1, 25))) for _ in range(30)] + ["of a", "PHONE date", ""]
    names = [" ".join(draw.choices(words, k=draw.randint(1, 120))) for _ in range(150)] + [a.upper() for a in asked[:5]]
    names += [f"{draw.choice(asked)} {' '.join(draw.choices(words, k=9))}" for _ in range(60)] + ["OF A", "Phone Date", "phone_date", "", None]
    return asked, names


@pytest.mark.parametrize(("few", "copies", "meetings", "kept"), [(10**9, 2, 0, False), (10**9, 40, 16, False), (10**9, 40, 0, True), (0, 2, 16, True)])
def test_semantic_join_writes_long_names_only_to_bring_them_together(spark, monkeypatch, few, copies, meetings, kept):
    """Names are scored as they are read, unless the queries are many, or most names have the same words and meet many."""
    asked, names = long_texts()
    queries = spark.createDataFrame([(q,) for q in asked * 2], "query string")
    held = spark.createDataFrame([(n,) for n in names * copies], "name string")
    pairs = queries.distinct().crossJoin(held.distinct()).where("query <> '' and name <> ''")
    pairs = pairs.withColumn("score", T.semantic_score(F.col("query"), F.col("name")))
    want = sorted(map(tuple, M._top(pairs.where("score >= 0.1"), 5).collect()))
    written, write = [], M.materialize
    monkeypatch.setattr(M, "FEW_BYTES", few, raising=False)
    monkeypatch.setattr(M, "FEW_MEETINGS", meetings, raising=False)
    monkeypatch.setattr(M, "materialize", lambda df: written.extend(df.columns) or write(df))
    assert sorted(map(tuple, M.semantic_join(queries, held, 0.1, 5).collect())) == want
    assert ("name" in written) is kept
