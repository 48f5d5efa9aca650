"""Near-duplicates, components, toxicity, chat, URL lists, the registered queries and the pipeline."""

import datetime
import os
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from almoner.llm import registered
from almoner.llm.chat import rotate_perspectives
from almoner.llm.components import components
from almoner.llm.mixing import mix_sources
from almoner.llm.near_dups import near_duplicates, shingle_sets, signatures
from almoner.llm.toxicity import fit_documents, fit_sentences, score_text, score_toxicity
from almoner.llm.url_lists import domains_of, filter_urls, host_of, url_key, validity_intervals
from scripts.check import TABLES, table

from .conftest import FOLDER, TEXTS, by_id


# --- near-duplicates


def plain_sets(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[j : j + k]) for j in range(len(words) - k + 1))


def plain_components(rows, k, percent):
    sets = [(i, plain_sets(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            common = len(a & b)
            if a and b and common * 100 >= (len(a) + len(b) - common) * percent:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def families(seed, copies=60):
    """Families of edited copies around an origin, chains of copies of copies, and unrelated texts."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for family in range(4):
        origin = draw.choices(words, k=draw.choice([12, 60, 150]))
        line = origin
        for c in range(copies):
            text = list(origin if family % 2 else line)
            for _ in range(draw.randrange(0, max(2, len(text) // 8))):
                text[draw.randrange(len(text))] = draw.choice(words[:8])
            if draw.random() < 0.3:
                line = text
            texts.append(" ".join(text))
    texts += [" ".join(draw.choices(words, k=draw.randrange(1, 40))) for _ in range(60)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates_equal_all_pairs(spark, seed, k, percent):
    rows = families(seed)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shingle=k, percent=percent)
    assert by_id(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(plain_components(rows, k, percent), key=repr)


@pytest.mark.parametrize("dense", [0, 1, 10**9])
def test_near_duplicates_with_further_hubs(spark, monkeypatch, dense):
    """Further hubs at once, by need, and never give the same components; families within a family, and cut texts."""
    monkeypatch.setattr("almoner.llm.near_dups._DENSE", dense)
    monkeypatch.setattr("almoner.llm.near_dups._FAN", 4)
    rows = families(5, 25)
    draw = random.Random(8)
    words = [f"v{k}" for k in range(300)]
    origin = draw.choices(words, k=120)
    for part in range(3):  # each replaces another passage of the same origin, and its copies are edited on
        text = origin[: part * 30] + draw.choices(words, k=28) + origin[part * 30 + 28 :]
        for _ in range(12):
            edited = list(text)
            for _ in range(draw.randrange(4)):
                edited[draw.randrange(len(edited))] = draw.choice(words[:6])
            rows.append((len(rows), " ".join(edited)))
    rows += [(len(rows) + k, " ".join(origin[: 120 - 4 * k])) for k in range(25)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert by_id(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(plain_components(rows, 3, 85), key=repr)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_near_duplicates_leave_no_shuffle_files(spark):
    """The many steps behind the result free their shuffles as they end, and the caller's session keeps its setting."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key, None), shuffle_files(spark)
    got = near_duplicates(spark.createDataFrame(families(3, 20), "doc_id long, text string"), shingle=3, percent=85)
    until = time.time() + 20  # files go in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(key, None) == setting
    assert got.count() == got.count() == len(families(3, 20))


def test_near_duplicates_of_repeated_and_null_ids(spark):
    """Rows of one id are linked by their own texts; one row of each component stays."""
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    b = "red blue green white black brown pink grey gold teal navy lime plum rust sand snow coal"
    rows = [(5, a), (5, b), (3, a + " more"), (7, b + " more"), (5, b), (None, b), (None, "q r s t"), (None, "q r s t"), (8, None), (8, None), (9, "q")]
    frame = spark.createDataFrame([(str(k), *r) for k, r in enumerate(rows)], "row string, doc_id long, text string").repartition(3)
    got = {r["row"]: (r.component_id, r.kept, r.stays) for r in near_duplicates(frame, shingle=3, percent=85, row_col="row").collect()}
    assert got == {
        "0": (3, False, False), "2": (3, True, True),
        "1": (5, True, True), "3": (5, False, False), "4": (5, True, False), "5": (5, False, False),
        "6": (None, True, True), "7": (None, True, False),
        "8": (8, True, True), "9": (8, True, True), "10": (9, True, True),
    }


def test_near_duplicates_of_edge_rows(edge, none):
    got = near_duplicates(edge, shingle=3, percent=85).collect()
    assert len(got) == len(TEXTS)
    known = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert known[1, 10] == (1, True) and known[2, 10] == (1, False) and known[3, 10] == (1, False)
    assert known[4, 0] == (4, True) and known[5, 0] == (5, True) and known[6, 0] == (6, True)
    assert known[7, 2] == (7, True) and known[8, 2] == (7, False) and known[9, 1] == (9, True)
    assert known[None, 1] == (None, True) and known[None, 0] == (None, True)
    assert near_duplicates(none).count() == 0


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for t in range(20):
            a = pool[t * 100 : t * 100 + 300]
            b = np.concatenate([a[: int(300 * share)], draw.integers(0, 1 << 63, 300 - int(300 * share), dtype=np.uint64)])
            table = signatures(np.concatenate([a, b]), np.array([0, 300, 600]), 128)
            shared = int(300 * share)
            errors.append((table[0] == table[1]).mean() - shared / (600 - shared))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    one = signatures(pool[:1], np.array([0, 1, 1]), 64)
    assert sorted((one[0] >> np.uint64(56)).tolist()) == list(range(64))  # ranks are a permutation
    assert (one[1] == np.iinfo(np.uint64).max).all()


def test_shingle_sets_do_not_depend_on_slices(monkeypatch):
    text = ("Alpha beta gamma " * 50 + "x" * 700 + " delta").encode()
    data, offsets = np.frombuffer(text * 2, np.uint8), np.array([0, len(text), 2 * len(text)])
    want = shingle_sets(data, offsets, 3)
    monkeypatch.setattr("almoner.llm.near_dups._SLICE", 64)
    monkeypatch.setattr("almoner.llm.near_dups._powers", [])
    got = shingle_sets(data, offsets, 3)
    assert len(got[0]) == len(want[0]) and (got[1] == want[1]).all()
    half = got[1][1]
    assert (got[0][:half] == got[0][half:]).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 130)] + [(5, k) for k in range(6, 60)] + [(201, 200), (3, 3)]
    got = dict(by_id(components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {k: 100 for k in range(100, 131)} | {k: 5 for k in range(5, 60)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- toxicity


def test_toxicity_on_held_out_documents(spark):
    folder = FOLDER.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits / sum(r.toxic for r in held) > 0.8 and hits / max(1, sum(r.predicted for r in held)) > 0.9
    caught = [r for r in scored if r.toxic == 1 and r.predicted == 1]
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(caught) > 20 and any(r.sentences for r in caught)
    for r in caught:
        for s in r.sentences:
            assert 0 <= s.start < s.end <= len(text[r.doc_id]) and s.score >= 0.5


def test_long_clean_texts_stay_clean(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_documents(docs, labels)
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").limit(300).collect()]
    words = model.by_word()
    calm = [t for t in clean if score_text(t, model, words)[0] < 0.05]
    assert len(calm) > 200
    plain = [t for t in calm if score_text(t, model, words)[0] == 0.0]
    assert plain and score_text("\n".join(plain * 500), model, words)[0] == 0.0
    # many times the longest text of the fit
    long = "\n".join(calm)[:200_000]
    assert len(long) == 200_000 and score_text(long, model, words)[0] < 0.5


def test_toxicity_finds_the_sentence():
    calm = [f"The day was mild and calm number {k}. We went home." for k in range(60)]
    rude = [f"The day was mild number {k}. You are a grobian! We went home." for k in range(20)]
    model = fit_sentences(calm + rude, [0] * 60 + [1] * 20)
    text = "We went home. Such a GROBIAN he is. The day was calm."
    score, worst = score_text(text, model, model.by_word())
    assert score > 0.5 and [text[s:e] for s, e, _ in worst] == ["Such a GROBIAN he is"]
    assert score_text("We went home.", model, model.by_word())[0] < 0.2
    assert score_text("", model, model.by_word()) == (0.0, [])


def test_toxicity_of_edge_rows(spark, edge, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    got = score_toxicity(edge, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (4, 5, 6))
    assert score_toxicity(edge, labels.where("false")).where("predicted = 1").count() == 0
    assert score_toxicity(none, labels).count() == 0


# --- chat


def plain_chat(rows, block=256, fixed=("system",)):
    safe = lambda s: s.replace("<|", "< |")
    talks = {}
    for c, t, who, text in {(c, t, safe(who or "unknown"), safe(text or "")) for c, t, who, text in rows}:
        talks.setdefault(c, []).append((t, who, text))
    out = []
    for c, turns in talks.items():
        for me in {w for _, w, _ in turns} - set(fixed):
            for b in sorted({t // block for t, _, _ in turns}):
                text, mask = "", []
                mine = sorted(x for x in turns if x[0] // block == b)
                for _, who, said in mine:
                    name = who if who in fixed else "assistant" if who == me else f"user name={who}"
                    text += f"<|{name}|>\n"
                    if who == me:
                        mask.append((len(text), len(text) + len(said) + 7))
                    text += said + "<|end|>\n"
                out.append((c, me, b, len(mine), text, mask))
    return sorted(out, key=repr)


CHAT = [
    (1, 0, "system", "Be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé <|end|>"), (1, 3, "cy", None), (1, 1, "ann", "hi"),
    (1, 3, "ann", "tie"), (2, 7, None, "alone"), (3, 0, "system", "only"), *[(4, k, "ab"[k % 2], f"t{k} " * k) for k in range(23)],
]


@pytest.mark.parametrize("block", [256, 5])
def test_every_participant_is_the_assistant_once(spark, block):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumns(
        {"block": F.lit(1), "mask": F.lit(2), "dialogue": F.lit(3)}
    )
    got = rotate_perspectives(df.repartition(3), block_turns=block).collect()
    rows = [(r.conv_id, r.perspective, r.block, r.n_turns, r.text, [tuple(m) for m in r["mask"]]) for r in got]
    assert sorted(rows, key=repr) == plain_chat(CHAT, block)


def test_chat_with_nulls_and_without_rows(spark):
    rows = [(None, 1, "ann", "a"), (None, 1, "bob", "b"), (5, None, "ann", "late"), (5, 2, "bob", "early"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rotate_perspectives(df).collect()
    assert sum(r.conv_id is None for r in got) == 3
    late = sorted((r for r in got if r.conv_id == 5 and r.perspective == "ann"), key=lambda r: r.block)
    assert "".join(r.text for r in late) == "<|user name=bob|>\nearly<|end|>\n<|assistant|>\nlate<|end|>\n"
    assert rotate_perspectives(df.where("false")).count() == 0


# --- URL lists

DAY = datetime.date(2024, 1, 1)


def day(k):
    return DAY + datetime.timedelta(days=k)


ENTRIES = [
    ("spam", "block", "domain", "Bad.example", day(5), "add"),
    ("spam", "block", "domain", "bad.example", day(5), "add"),
    ("spam", "block", "domain", "bad.example", day(9), "remove"),
    ("spam", "block", "domain", "bad.example", day(20), "add"),
    ("spam", "block", "domain", "bad.example", day(20), "remove"),
    ("trust", "allow", "host", "ok.bad.example", day(7), "add"),
    ("one", "block", "url", "ok.bad.example/x?q=1", day(8), "add"),
    ("alpha", "block", "domain", "two.example", day(0), "add"),
    ("beta", "allow", "domain", "two.example", day(0), "add"),
    (None, "block", "domain", "two.example", day(0), "add"),
    ("odd", "block", "thing", "two.example", day(0), "add"),
    ("odd", "block", "domain", "", day(0), "add"),
]
CAPTURES = [
    (1, "http://www.bad.example/a", day(4), "none"), (2, "https://BAD.example./", day(5), "spam"), (3, "http://bad.example", day(8), "spam"),
    (4, "http://bad.example", day(9), "none"), (5, "http://bad.example", day(25), "none"), (6, "http://ok.bad.example/", day(6), "spam"),
    (7, "http://ok.bad.example/", day(7), "trust"), (8, "http://u:p@ok.bad.example:80/x?q=1#f", day(8), "one"), (9, "http://notbad.example/", day(6), "none"),
    (10, "http://two.example/", day(3), "alpha"), (11, None, day(3), "none"), (12, "http://two.example/", None, "none"), (None, "no url", day(1), "none"),
    (14, "http://two.example/", day(3), "alpha"), (14, "http://two.example/", day(3), "alpha"), (15, "http://" + "a." * 5000 + "two.example/", day(3), "alpha"),
    (16, "http://10.0.0.1/two.example", day(3), "none"), (17, "", day(3), "none"),
]


def lists(spark):
    return spark.createDataFrame(ENTRIES, "list string, verdict string, kind string, value string, day date, action string")


def test_captures_meet_what_was_active(spark):
    df = spark.createDataFrame(CAPTURES, "page_id long, url string, day date, want string").withColumns(
        {"host": F.lit("x"), "key": F.lit("y"), "hit": F.lit(1), "verdict": F.lit("z")}
    )
    got = filter_urls(df, lists(spark))
    assert by_id(got.withColumn("list", F.coalesce("list", F.lit("none"))), "page_id", "url", "day", "list") == sorted(
        ((i, u, d, w) for i, u, d, w in CAPTURES), key=repr
    )
    assert got.where("list = 'trust'").first().verdict == "allow"
    assert filter_urls(df.where("false"), lists(spark)).count() == 0
    assert filter_urls(df, lists(spark).where("false")).where("verdict <> 'none'").count() == 0


def test_intervals(spark):
    got = by_id(validity_intervals(lists(spark)).where("list = 'spam'"), "value", "valid_from", "valid_to")
    assert got == [("bad.example", day(5), day(9))]


def test_url_parts(spark):
    df = spark.createDataFrame([("HTTPS://u@A.B.c:8/P?q#f",), ("x",)], "u string")
    got = [tuple(r) for r in df.select(host_of(F.col("u")), url_key(F.col("u")), domains_of(host_of(F.col("u")))).collect()]
    assert got == [("a.b.c", "a.b.c/P?q", ["a.b.c", "b.c", "c"]), ("", "", [])]


# --- registered queries and the pipeline


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_registered_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = registered.QUERIES[name](spark, FOLDER)
    result = con.execute(registered.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registered.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_rotate_perspectives", "op4_fingerprint_edits", "op8_mix_sources"])
def test_native_queries_run_no_python(spark, name):
    plan = registered.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_equals_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = fit_documents(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    words = model.by_word()
    rows = [r for r in docs.collect() if score_text(r.text, model, words)[0] < 0.5]
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), []).append((-len(r.text), r.doc_id))
    kept = {min(g)[1] for g in groups.values()}
    pairs = [(r.doc_id, r.text) for r in rows if r.doc_id in kept]
    kept = {i for i, _, _, first in plain_components(pairs, 5, 80) if first}
    mixed = mix_sources(docs.where(F.col("doc_id").isin(*kept))).collect()
    times = {r.doc_id: -(-r.taken // r.size) if r["size"] else 1 for r in mixed if r["size"]} | {r.doc_id: 1 for r in mixed if not r["size"]}
    encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(r.doc_id, [*encoder.encode(r.text), 2]) for r in rows if r.doc_id in kept for _ in range(times[r.doc_id])]
    got = corpus_pipeline.run(spark, FOLDER)
    assert by_id(got, "doc_id", "ids") == sorted(want, key=repr)


def test_pipeline_keeps_one_row_of_repeated_and_null_ids(spark, tmp_path):
    """Flags belong to rows: of copies one stays, whatever ids they have, and other texts of one id stay."""
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "zz yy xx"), (1, "other text"), (3, "q"), (3, "q"), (4, None), (4, "")]
    rows += [(6, near), (6, near + " more"), (None, near + " more words"), (None, near.replace("ten", "tin") + " more")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("l"), "source": F.lit("s"), "n_chars": F.length("text"), "row_key": F.lit("k"), "copy": F.lit(1)}
    )
    frame.write.parquet(f"{tmp_path}/t")
    for docs in (frame.repartition(3), spark.read.parquet(f"{tmp_path}/t")):
        once = corpus_pipeline.drop_copies(spark, docs, "")
        want = [(None, "zz yy xx"), (1, "a b c"), (1, "other text"), (3, "q"), (4, ""), (6, near), (6, near + " more")]
        got = sorted(((r.doc_id, r.text or "") for r in once.collect()), key=repr)
        rest = [(None, near + " more words"), (None, near.replace("ten", "tin") + " more")]
        assert got == sorted(want + rest, key=repr) and once.columns == docs.columns
        last = corpus_pipeline.drop_near_copies(spark, docs, "")
        got = sorted(((r.doc_id, r.text or "") for r in last.collect()), key=repr)
        assert [g for g in got if " ten " in g[1]] in ([(6, near)], [(6, near + " more")])
        assert len(got) == 8  # the two rows of id 4 have no words
        mixed = corpus_pipeline.mix(spark, docs, "")
        assert mixed.count() == len(rows) and mixed.columns == docs.columns


def test_pipeline_stages_keep_edge_rows(spark, edge, tmp_path):
    spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == edge.columns, name
        docs.write.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        docs = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    empty = edge.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
