"""Ordered edits, change sets and merges against a plain replay, with one hot key."""

import random

from pyspark.sql import functions as F

from almoner.operators import fields as E
from almoner.operators import joins as J
from almoner.operators import migrate as M
from almoner.operators.quality import FieldMeta
from almoner.sources.sinks import apply_changes, link_edges, unlink_edges

META = [FieldMeta("tags", "MultiSelect", ("a", "b", "c")), FieldMeta("note", "OneLineText")]


def parse(text):
    sep = "|" if "|" in (text or "") else ","
    return [x.strip() for x in (text or "").split(sep) if x.strip()]


def replay(cell, edits):
    tags, note = cell
    for field, op, value in edits:
        if value is None:
            continue
        if field == "tags":
            if op == "append" or (op in ("add", "replace") and not set(parse(value)) <= {"a", "b", "c"}):
                continue
            now = parse(tags)
            if op == "replace":
                tags = value
                continue
            if op == "add" and value not in now:
                now.append(value)
            if op == "remove" and value in now:
                now.remove(value)
            tags = "|".join(now)
        elif op == "replace":
            note = value
        elif op == "append":
            note = value if not note else f"{note} {value}"
    return tags, note


def test_batch_update_replays_edits_in_order(spark):
    rng = random.Random(5)
    start = {k: (rng.choice([None, "", "a", "a|a|b", "b,c", "zz|a"]), rng.choice([None, "", "hi"])) for k in range(12)}
    edits = []
    for seq in range(1500):
        key = 0 if rng.random() < 0.4 else rng.randrange(12)
        field = rng.choice(["tags", "tags", "note"])
        op = rng.choice(["add", "add", "remove", "remove", "append", "replace"])
        if op == "replace" and rng.random() < 0.8:
            op = "add"
        value = rng.choice(["a", "b", "c", "zz", None]) if field == "tags" else rng.choice(["x", "y", None])
        edits.append((key, field, op, value, seq))
    rows = [(k, *v) for k, v in start.items()]
    df = spark.createDataFrame(rows, "k int, tags string, note string")
    ops = spark.createDataFrame(rng.sample(edits, len(edits)), "k int, field string, op string, value string, seq bigint")
    # numbers without gaps, and numbers like times in microseconds
    for number in (F.col("seq"), F.col("seq") * 86_400_000_017 + 1_700_000_000_000_000):
        edited = E.batch_update(df, ops.withColumn("seq", number), META, "k")
        got = {r["k"]: (r["tags"], r["note"]) for r in edited.collect()}
        for key, cell in start.items():
            mine = [(f, o, v) for k, f, o, v, _ in edits if k == key]
            want = replay(cell, mine)
            assert parse(got[key][0]) == parse(want[0]), key
            assert got[key][1] == want[1], key


def test_batch_update_takes_times_as_order_and_gathers_no_edits(spark):
    df = spark.createDataFrame([(1, "a|b", "hi"), (2, None, None)], "k int, tags string, note string")
    ops = spark.createDataFrame(
        [
            (1, "tags", "remove", "a", "2024-01-01 00:00:00"),
            (1, "tags", "add", "a", "2024-01-01 00:00:01"),
            (1, "note", "append", "x", "2024-01-03 00:00:00"),
            (1, "note", "append", "w", "2024-01-02 00:00:00"),
            (None, "note", "append", "lost", "2024-01-02 00:00:00"),
            (2, None, "append", "lost", "2024-01-02 00:00:00"),
        ],
        "k int, field string, op string, value string, seq string",
    ).withColumn("seq", F.col("seq").cast("timestamp"))
    out = E.batch_update(df, ops, META, "k")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "b|a", "hi w x"), (2, None, None)]
    assert sorted(tuple(r) for r in E.batch_update(df, ops.limit(0), META, "k").collect()) == sorted(tuple(r) for r in df.collect())


def test_option_edits(spark, rows):
    df = spark.createDataFrame([(["a", "b", "a"],), (None,), ([],)], "l array<string>")
    assert rows(df.select(E.add_option(F.col("l"), "b"))) == [(["a", "b", "a"],), (["b"],), (["b"],)]
    assert rows(df.select(E.remove_option(F.col("l"), "a"))) == [(["b", "a"],), ([],), ([],)]
    text = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    assert rows(text.select(E.append_text(F.col("t"), "y"))) == [("x y",), ("y",), ("y",)]


def replay_changes(table, changes):
    state = {k: dict(v) for k, v in table.items()}
    for key, op, values, names in changes:
        if op == "delete":
            state.pop(key, None)
        elif op in ("create", "put"):
            state[key] = dict(values)
        elif key in state:
            state[key].update({n: values[n] for n in names})
    return state


def test_apply_changes_replays_in_order(spark):
    rng = random.Random(6)
    table = {k: {"a": k, "b": f"b{k}"} for k in range(8)}
    changes = []
    for _ in range(300):
        key = 3 if rng.random() < 0.4 else rng.randrange(12)
        op = rng.choice(["put", "create", "delete", "patch", "patch", "patch"])
        values = {"a": rng.choice([None, rng.randrange(100)]), "b": rng.choice([None, f"n{rng.randrange(9)}"])}
        changes.append((key, op, values, rng.choice([["a"], ["b"], ["a", "b"]])))
    df = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in table.items()], "k int, a int, b string")
    log = spark.createDataFrame(
        [(k, v["a"], v["b"], i, op, n) for i, (k, op, v, n) in enumerate(changes)],
        "k int, a int, b string, seq int, op string, set_columns array<string>",
    )
    got = {r["k"]: {"a": r["a"], "b": r["b"]} for r in apply_changes(df, log, "k").collect()}
    want = replay_changes(table, changes)
    assert got == {k: {"a": v["a"], "b": v["b"]} for k, v in want.items()}


def test_edges(spark, rows):
    edges = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    more = spark.createDataFrame([(1, 3), (4, 5)], "a int, b int")
    assert rows(link_edges(edges, more)) == [(1, 2), (1, 3), (4, 5)]
    assert rows(unlink_edges(edges, more)) == [(1, 2)]


def test_chunk_merge_and_report(spark, rows):
    one = spark.createDataFrame([("2", "x", 1), ("10", "y", 1), (None, "z", 1)], "k string, a string, seq int")
    two = spark.createDataFrame(
        [("2", "p", None, 1), ("2", "q", None, 2), ("9", "r", "s", 1)], "k string, b string, a string, seq int"
    )
    merged = J.merge_column_chunks([one, two], "k", "seq")
    assert rows(merged, "k", "a", "b") == [("10", "y", None), ("2", None, "q")]
    report = J.chunk_consistency([one, two], "k")
    assert rows(report) == [(0, 2, 0, 0), (1, 2, 1, 1)]


def test_merge_sources_and_append(spark, rows):
    one = spark.createDataFrame([(1, "", None), (2, "b", "t")], "id int, n string, m string")
    two = spark.createDataFrame([(1, "a", "u"), (3, "c", "v")], "id int, n string, w string")
    assert rows(J.merge_sources([one, two], "id"), "id", "n", "m", "w") == [
        (1, "a", None, "u"),
        (2, "b", "t", None),
        (3, "c", None, "v"),
    ]
    assert rows(J.append_missing(one, one.select("id", "n", "m").limit(1), "id")) == rows(one)


def test_campaign_match_counts_each_pair_once(spark, rows):
    campaigns = spark.createDataFrame([("1", "One"), ("2", "Two"), ("3", "One"), ("4", "None")], "campaign_id string, campaign_name string")
    gifts = spark.createDataFrame(
        [(1, "1", "One"), (2, None, "Two"), (3, "2", None), (4, "9", "Else"), (5, None, None)],
        "gift int, donation_campaign_id string, donation_campaign_name string",
    )
    assert rows(J.campaign_join(campaigns, gifts), "campaign_id", "gift") == [
        ("1", 1),
        ("2", 2),
        ("2", 3),
        ("3", 1),
        ("4", None),
    ]


def test_migration_strategies(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", None, ["x"], ["y", "x"]), (2, "zz", "b", None, ["y"]), (3, None, "c", [], None)],
        "k int, s string, tags string, l1 array<string>, l2 array<string>",
    )
    meta = META
    plan = [M.FieldMapping("s", "tags", "ADD_OPTION"), M.FieldMapping("l1", "l2", "MERGE")]
    done = M.migrate(df, plan, meta)
    status = F.array_join(F.transform(M.STATUS, lambda s: s["status"]), ",")
    assert rows(done.select("k", "tags", "l2", status)) == [
        (1, "a", ["y", "x"], "success,success"),
        (2, "b", ["y"], "failed,no_source"),
        (3, "c", [], "no_source,success"),
    ]
    dry = M.migrate(df, plan, meta, dry_run=True)
    assert rows(dry, "k", "tags") == rows(df, "k", "tags")
    alone = [M.FieldMapping("s", "tags", "TRANSFORM", validate=False)]
    assert M.migration_report(M.migrate(df, alone, meta)).first()["successful"] == 0


def test_pair_reports_agree_and_plan_many_fields(spark):
    kinds = ["OneLineText", "Email", "YesNo", "Number", "Date"]
    many = [FieldMeta(f"f{i}", kinds[i % 5], required=i % 7 == 0) for i in range(300)]
    wide = spark.range(3).select("id", *[F.lit("yes" if i % 2 else None).cast("string").alias(m.name) for i, m in enumerate(many)])
    assert M.all_pair_report(wide, many).count() == 300 * 299
    df = spark.createDataFrame(
        [(1, "yes", "a@b.org", None), (2, None, "", "yes"), (2, "x", None, None), (None, "no", "no", "no")],
        "k int, f0 string, f1 string, f2 string",
    )
    few = many[:3]
    listed = M.row_pair_report(df, few, "k")
    by_pair = {(r["source"], r["target"]): r for r in M.all_pair_report(df, few).collect()}
    for (source, target), r in by_pair.items():
        of_pair = listed.where((F.col("source") == source) & (F.col("target") == target))
        got = dict(of_pair.groupBy("status").count().collect())
        assert [got.get(s, 0) for s in ("success", "failed", "skipped")] == [r["success"], r["failed"], r["skipped"]]
    totals = sorted((r["k"] or 0, *list(r)[1:]) for r in M.row_pair_totals(df, few, "k").collect())
    counts = listed.groupBy("k").pivot("status", ["success", "failed", "skipped"]).count().na.fill(0).collect()
    for r in counts:
        mine = [t for t in totals if t[0] == (r["k"] or 0)]
        assert [sum(t[i] for t in mine) for i in (2, 3, 4)] == [r["success"], r["failed"], r["skipped"]]
    one = listed.where("k = 1 AND source = 'f0' AND target = 'f1'").collect()
    assert [tuple(r) for r in one] == [(1, "f0", "f1", "failed", "Migration execution failed", "yes", "a@b.org")]
    assert M.row_pair_report(df.limit(0), few, "k").count() == 0
