"""Importance resampling, fill-in-the-middle, archives."""

import gzip
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almoner.llm import fill_middle as fm
from almoner.llm import resampling as rs
from almoner.llm import warc
from almoner.session import scratch_folder

from .conftest import FOLDER, TEXTS, by_id


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- importance resampling


def plain_draw(docs, targets, max_n=1, buckets=10_000, min_words=20, percent=10, seed="2024"):
    """Every score computed and sorted in one place."""

    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def ids(text):
        w = words(text)
        runs = [" ".join(w[k : k + n]) for n in range(1, max_n + 1) for k in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(ids(text))
    for text in targets:
        t.update(ids(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for key, text in docs:
        found = ids(text)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in found
        )
        h = int(sha(f"{seed}:{'' if key is None else key}")[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("options", [{}, {"max_n": 3, "buckets": 500}, {"percent": 60, "min_words": 1}, {"seed": "x", "percent": 100}])
def test_resampling_equals_a_plain_sort(spark, small, options):
    docs = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = plain_draw(docs, [r.text for r in bench.collect()], **options)
    got = rs.resample_to_target(small, bench, cells=7, bracket_rows=10, **options)
    assert by_id(got, *COLUMNS) == want


def test_resampling_of_odd_rows(edge, none):
    rows = edge.withColumns({c: F.lit(1) for c in ("low", "tie", "rank", "weight", "inside", "offset")})
    docs = [(i, text) for i, text, _ in TEXTS]
    target = rows.select(F.col("text").alias("t")).limit(3)
    want = plain_draw(docs, [r.t for r in target.collect()], percent=50, min_words=2)
    got = rs.resample_to_target(rows, target, target_col="t", percent=50, min_words=2, bracket_rows=1)
    assert by_id(got, *COLUMNS) == want
    assert rs.resample_to_target(none, target, target_col="t").count() == 0
    assert rs.resample_to_target(rows, none, percent=100, min_words=1).where("rank is not null").count() == 10


def test_resampling_ties_take_the_smaller_id(spark):
    # one id repeated: equal scores, and the cut falls between its rows
    rows = spark.createDataFrame([(5, "a " * 30)] * 7 + [(None, "a " * 30)] * 3, "doc_id long, text string")
    got = rs.resample_to_target(rows, rows, percent=50, bracket_rows=1)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("bracket_rows", [1, 5, 1000])
def test_kth_smallest_with_any_ties(spark, bracket_rows):
    draw = np.random.default_rng(4)
    for values in (draw.integers(0, 3, 400), draw.integers(-(10**12), 10**12, 400), np.r_[np.zeros(399, int), 5], np.repeat(7, 50)):
        pairs = sorted(zip(values.tolist(), draw.integers(0, 40, len(values)).tolist()))
        frame = spark.createDataFrame(pairs, "a long, b long").repartition(3).cache()
        for k in (1, 2, len(pairs) // 3, len(pairs)):
            assert rs.kth_smallest(frame, ["a", "b"], k, bracket_rows, spread=0.01) == pairs[k - 1]
        frame.unpersist()
    with pytest.raises(ValueError):
        rs.kth_smallest(frame, ["a"], 0)


# --- fill-in-the-middle


def plain_middle(key, text, seed="7", rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = [int(sha(f"{seed}:{'' if key is None else key}")[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return key, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = ["\n", "\n\n\n", "a\n", "a\nb", "é\n日本\n🙂🙂\nend", "<P>", "x<S>y\nz", "<", "<P", "S>\n<", "<M\n>", "\n<<PP>>\n<S", "a\n" * 5000]


@pytest.mark.parametrize("options", [{}, {"rate": 40, "spm_rate": 80, "seed": "q"}])
def test_middle_equals_plain_and_comes_back(spark, edge, options):
    draw = np.random.default_rng(2)
    made = ["".join(draw.choice(list("ab\n\n<>PSMé🙂"), draw.integers(40))) for _ in range(600)]
    rows = [(i, t) for i, t, _ in TEXTS] + [(100 + k, t) for k, t in enumerate(LINES + made)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("form", "n", "output")})
    got = fm.fill_in_middle(frame, **options)
    want = sorted((plain_middle(i, t, **options) for i, t in rows), key=repr)
    assert by_id(got, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == want
    back = fm.restore_text(got.withColumn("extra", F.lit(1)).select("extra", "output", "doc_id", "form"))
    assert back.columns == ["extra", "doc_id", "form", "output", "text"]
    assert by_id(back, "doc_id", "text") == sorted(((i, t or "") for i, t in rows), key=repr)


def test_middle_in_small_slices(spark, monkeypatch):
    texts = ["", "x\ny\nz", "<P>", "", "é\n" * 50, "a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    whole = fm.rearrange(data, offsets, fm._draws(list(range(6)), "7"), 100, 50)
    import pyarrow as pa

    monkeypatch.setattr(fm, "_SLICE", 3)
    outs = []
    for first, end, part, ends in fm._slices(pa.array([b""] + [t.encode() for t in texts]).slice(1)):
        out, _, _ = fm.rearrange(part, ends, fm._draws(list(range(first, end)), "7"), 100, 50)
        outs.append(out)
    assert np.array_equal(np.concatenate(outs), whole[0])


def test_middle_of_nothing_and_of_damaged_outputs(spark, none):
    made = fm.fill_in_middle(none)
    assert made.count() == 0 and fm.restore_text(made).count() == 0
    bad = spark.createDataFrame([("<P>a<S>b", "psm")], "output string, form string")
    with pytest.raises(Exception, match="each mark once"):
        fm.restore_text(bad).collect()
    odd = spark.createDataFrame([(None, "plain"), ("t", None)], "output string, form string")
    assert sorted(r.text for r in fm.restore_text(odd).collect()) == ["", "t"]


# --- archives


def pages_of(spark):
    long = "p" * 150
    rows = [(i, f"http://a/{i} x\r\n", t) for i, t, _ in TEXTS]
    rows += [(50, "http://b", long), (40, None, long), (60, "http://b", long), (40, "http://c", long), (None, None, long)]
    rows += [(70, "http://d", "é" * 50), (71, "http://d", "é" * 50), (80, "u", "é" * 49), (81, "u", "é" * 49)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return rows, frame.withColumns({c: F.lit("x") for c in ("first", "digest", "size", "salt", "payload", "held", "path")})


def plain_archive(rows):
    first = {}
    for i, _, t in rows:
        if len((t or "").encode()) >= 100:
            first.setdefault(t, []).append(i)
    out = []
    for i, _, t in rows:
        t = t or ""
        held = [x for x in first.get(t, []) if x is not None]
        again = bool(held) and i != min(held)
        out.append((i, len(t.encode()), sha(t), "revisit" if again else "response", min(held) if again else None))
    return sorted(out, key=repr)


PAGE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_archives_of_odd_rows(spark):
    rows, frame = pages_of(spark)
    assert by_id(warc.archive_pages(frame.repartition(3), scratch_folder(spark), file_bytes=2000), *PAGE) == plain_archive(rows)
    assert warc.archive_pages(frame.where("false"), scratch_folder(spark)).count() == 0


def test_archives_hold_payloads_and_standard_headers(spark):
    rows, frame = pages_of(spark)
    manifest = warc.write_warc(frame, scratch_folder(spark))
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    read = warc.read_warc(manifest)
    held = {(r.record_id, bytes(r.payload).decode()) for r in read.where("record_type = 'response'").collect()}
    assert {(warc.record_id(i), t or "") for i, _, t in rows if len((t or "").encode()) < 100} <= held
    assert read.where("record_type = 'revisit'").select(F.max(F.octet_length("payload"))).first()[0] == 0
    path = manifest.first().path.removeprefix("file:")
    with gzip.open(path) as f:  # any reader of concatenated members can read them
        head = f.read(200)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert not read.where("url rlike '[\\\\x00-\\\\x20]'").count()


def one(key, body=None, plain=False):
    body = f"payload {key} ".encode() * 40 if body is None else body
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", warc.record_id(key)), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(body).hexdigest())]
    packed = warc.pack_record([*headers, ("Content-Type", "application/http;msgtype=response")], warc._head("200 OK", len(body)) + body)
    return gzip.decompress(packed) if plain else packed


def salvage(tmp_path, data):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    reader = warc.SalvageReader(str(path))
    items = list(reader)
    reader.close()
    spans = sorted({(x[0], x[1]) if isinstance(x, tuple) else (x.start, x.end) for x in items})
    assert spans == [] or spans[0][0] == 0 and spans[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # every byte is in a record or in a gap
    keys = [int(x.headers["warc-record-id"][10:-1]) for x in items if not isinstance(x, tuple)]
    return keys, [x for x in items if isinstance(x, tuple)]


def test_salvage_of_damaged_members(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_BLOCK", 64)
    monkeypatch.setattr(warc, "_CHUNK", 32)
    parts = [one(k) for k in range(6)]
    ends = np.cumsum([0] + [len(p) for p in parts]).tolist()
    whole = b"".join(parts)
    assert salvage(tmp_path, whole) == (list(range(6)), [])
    draw = np.random.default_rng(1)
    for _ in range(60):  # any changed bytes of the third: it alone is lost
        bad = bytearray(whole)
        at = int(draw.integers(ends[2] + 10, ends[3] - 4))  # behind the header, whose time and name fields mean nothing
        bad[at] ^= int(draw.integers(1, 256))
        keys, gaps = salvage(tmp_path, bytes(bad))
        assert keys == [0, 1, 3, 4, 5] and [g[:2] for g in gaps] == [(ends[2], ends[3])]
    keys, gaps = salvage(tmp_path, whole[: ends[1]] + b"\x1f\x8b\x08 noise WARC/1.1\r\n" + whole[ends[1] :])
    assert keys == list(range(6)) and [g[0] for g in gaps] == [ends[1]]
    keys, gaps = salvage(tmp_path, whole[:-5])
    assert keys == list(range(5)) and gaps[0][0] == ends[5]
    keys, gaps = salvage(tmp_path, whole[: ends[1] + 20] + whole[ends[4] + 20 :])
    assert keys == [0, 5] and len(gaps) == 1
    assert salvage(tmp_path, b"") == ([], [])
    assert salvage(tmp_path, b"no archive at all")[0] == []


def test_salvage_of_plain_records_and_wrong_claims(tmp_path):
    parts = [one(k, plain=True) for k in range(4)]
    ends = np.cumsum([0] + [len(p) for p in parts]).tolist()
    assert salvage(tmp_path, b"".join(parts)) == ([0, 1, 2, 3], [])
    for old, new in ((b"payload 1 ", b"payload x "), (b"Content-Length: ", b"Content-Length: 9"), (b"WARC-Type: ", b"WARC-Typ: "), (b"WARC/1.1", b"WARC/9.1")):
        changed = [parts[0], parts[1].replace(old, new), *parts[2:]]
        keys, gaps = salvage(tmp_path, b"".join(changed))
        assert keys == [0, 2, 3] and [g[:2] for g in gaps] == [(ends[1], ends[1] + len(changed[1]))], new
    # sound members whose record is wrong are left whole; members of several records, and both kinds in one file
    wrong = gzip.compress(parts[1].replace(b"payload 1 ", b"payload x "))
    keys, gaps = salvage(tmp_path, one(7) + wrong + parts[2] + gzip.compress(parts[0] + parts[3]))
    assert keys == [7, 2, 0, 3] and [g[2] for g in gaps] == ["block digest"]


def test_gaps_are_rows(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a").write_bytes(one(1) + b"rubbish" + one(2))
    (folder / "b").write_bytes(b"")
    files = spark.createDataFrame([(str(folder / "a"),), (str(folder / "b"),), (None,)], "path string")
    rows = warc.read_warc(files).orderBy("start").collect()
    assert [(r.quarantined, r.end - r.start) for r in rows if r.quarantined] == [("no record begins here", 7)]
    assert [warc._ID.match(r.record_id)[1] for r in rows if not r.quarantined] == ["1", "2"]
