"""Top-k search, WARC archives, tool calls, shards, mixes, the pipeline."""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import TABLES, difference
from riskloom.llm import decontaminate, mixing, registry, sharding, toolcalls, topk, toxicity, warc
from riskloom.operators import joins
from tests.conftest import SF
from tests.llm.test_models import frame, planted


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_twin(spark, twin, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    assert difference(mine, twin.execute(entry.oracle_sql()[name]).df()) == ""


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in registry.QUERIES}
    assert "pipeline" in entry.queries()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int, score long")


def test_top_k_ties_nulls_and_sparse_rows(spark):
    rows = [(i, [0.5, 0.0, float(i % 3)], 0, 0, 0) for i in range(0, 120)]
    rows += [(200, None, 0, 0, 0), (250, [float("nan"), 1.0, 0.0], 0, 0, 0), (300, [None, 1.0, 1.0], 0, 0, 0), (None, [1.0, 1.0, 1.0], 0, 0, 0), (350, [1.0], 0, 0, 0)]
    table = vectors(spark, rows)
    v = table.where(topk.usable("embedding")).select("vec_id", topk.quantised("embedding").alias("v"))
    got = defaultdict(list)
    for r in topk.top_k(v.where("vec_id % 50 = 0"), v).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [int(np.floor(256 * x)) for x in e] for i, e, *_ in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    for q in (0, 50, 100, 350):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert set(got) == {0, 50, 100, 350}
    few = v.where("vec_id IN (0, 1, 2)")
    assert topk.top_k(few.where("vec_id = 0"), few).count() == 2
    assert topk.top_k(few.where("false"), few).count() == topk.top_k(few, few.where("false")).count() == 0


def test_top_k_sends_no_blocks_to_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(2)
    whole = rng.integers(-9, 10, (300, 6))
    v = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(whole)], "vec_id long, v array<long>").repartition(3)
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERIES", 8)
    found = topk.top_k(v.where("vec_id % 5 = 0"), v, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 300, 5))
    for q, best in got.items():
        scores = sorted((-int(whole[q] @ w), i) for i, w in enumerate(whole) if i != q)[:3]
        assert best == [(i, -s) for s, i in scores]


def records(data):
    return [x for x in warc.salvage(data) if x[0] == "record"], [x for x in warc.salvage(data) if x[0] == "gap"]


def test_salvage_recovers_what_follows_damage():
    plain = [warc.record("response", i, None, "d", 3, b"abc%d" % i) for i in range(6)]
    for make in (lambda r: r, warc.member):
        parts = [make(r) for r in plain]
        bad = bytearray(parts[2])
        bad[len(bad) // 2] ^= 0xFF
        data = parts[0] + parts[1] + bytes(bad) + b"junk" + parts[3] + parts[4] + parts[5][:-9]
        good, gaps = records(data)
        assert [r[3]["warc-record-id"] for r in good] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
        assert [(g[1], g[2]) for g in gaps] == [(len(parts[0] + parts[1]), len(bad) + 4), (len(data) - len(parts[5]) + 9, len(parts[5]) - 9)]
        assert sum(g[2] for g in gaps) + sum(r[2] for r in good) == len(data)
    mixed = plain[0] + warc.member(plain[1] + plain[2]) + b"\0" + warc.member(plain[3])
    assert [len(x) for x in records(mixed)] == [4, 0]
    assert records(b"") == ([], []) and records(b"no archive")[1][0][1:3] == (0, 10)


def test_salvage_keeps_the_good_records_of_a_damaged_member(spark, tmp_path):
    rng = np.random.default_rng(3)
    plain = [warc.record("response", i, None, "d", 3, rng.integers(0, 64, 3000, np.uint8).tobytes().hex().encode()) for i in range(60)]
    bad = bytearray(plain[20])
    bad[-9] ^= 1
    rotten = warc.member(b"".join([*plain[:20], bytes(bad), *plain[21:]]))
    whole, after = warc.member(b"".join(plain)), warc.member(plain[0])
    ids = lambda rows: [warc._id(r[3]["warc-record-id"]) for r in rows]
    good, gaps = records(b"junk" + rotten + after)
    start = sum(map(len, plain[:20]))
    assert ids(good) == [i for i in range(60) if i != 20] + [0]
    assert [g[1:4] for g in gaps] == [(0, 4, "no version line"), (4, len(rotten), "block digest differs")] and gaps[1][5:] == (start, len(bad))
    cut = whole[: len(whole) // 2]
    good, gaps = records(cut)
    assert ids(good) == list(range(len(good))) and 25 < len(good) < 35
    assert len(gaps) == 1 and gaps[0][1] == good[0][2] and gaps[0][1] + gaps[0][2] == len(cut)
    flipped = bytearray(whole)
    flipped[len(whole) // 2 : len(whole) // 2 + 40] = b"\xff" * 40
    good, gaps = records(bytes(flipped) + after)
    assert ids(good)[:25] == list(range(25)) and ids(good)[-1] == 0 and "broken member" in [g[3] for g in gaps]
    trailer = bytearray(whole)
    trailer[-6] ^= 1
    assert ids(records(bytes(trailer))[0]) == list(range(60))
    (tmp_path / "one.warc.gz").write_bytes(rotten)
    out = warc.read_warc(spark, str(tmp_path)).collect()
    assert [(r["inner_offset"], r["inner_length"]) for r in out if r["kind"] == "gap"] == [(start, len(bad))] and len(out) == 60


def test_warc_round_trip_with_nulls_copies_and_long_pages(spark, tmp_path):
    page, long = "<p>é</p>" * 20, "x" * 3_000_000
    rows = [(5, "http://a/\r\nb", page), (3, None, page), (9, "u", page), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (None, "u", page), (10, "u", long), (3, "u", page)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_warc(pages, str(tmp_path / "w"))
    out = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r["kind"] == "record" and r["reason"] is None for r in out)
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in out)
    assert got == Counter([
        (5, "revisit", 3, 180), (3, "response", None, 180), (3, "response", None, 180), (9, "revisit", 3, 180), (4, "response", None, 0),
        (6, "response", None, 0), (7, "response", None, 5), (8, "response", None, 5), (None, "revisit", 3, 180), (10, "response", None, 3_000_000),
    ])
    assert next(r for r in out if r["page_id"] == 10)["payload"] == long.encode()
    warc.write_warc(pages.where("false"), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0


CALL = "conv_id long, id string, parent string, name string, arguments string, depth long"


def test_tool_calls_are_linked_ordered_and_checked(spark):
    ok = '{"turn": 1.0, "text": "é"}'
    calls = spark.createDataFrame(
        [(1, "a", None, "reply", ok, 0), (1, "b", "a", "reply", '{"text":""}', 0), (1, "c", "b", "other", "{}", 0), (1, "d", "c", "reply", "{bad", 0),
         (1, "x", "y", "reply", ok, 0), (1, "y", "x", "reply", ok, 0), (1, "d", "c", "reply", "{bad", 0), (1, None, None, "reply", ok, 0), (1, "e", "gone", "reply", None, 0)], CALL)
    results = spark.createDataFrame([(1, "a", "fine"), (1, "b", None), (1, "b", "z"), (1, "q", "lost"), (1, None, "none")], "conv_id long, id string, content string")
    got = {r["id"]: r for r in toolcalls.link_calls(calls, results).collect()}
    assert {i: (r["depth"], r["status"]) for i, r in got.items()} == {
        "a": (0, "linked"), "b": (1, "ambiguous"), "c": (2, "open"), "d": (3, "repeated"), "x": (None, "cycle"), "y": (None, "cycle"), "q": (None, "orphan"), "e": (0, "open"),
    }
    assert got["a"]["message"] == '{"arguments":{"text":"é","turn":1.0},"id":"a","name":"reply","order":0,"result":"fine"}'
    assert got["a"]["valid"] and got["b"]["problems"] == "$.turn: missing; $.text: too short"
    assert got["c"]["problems"] == "$: unknown tool" and got["d"]["problems"] == got["e"]["problems"] == "$: not JSON"
    assert toolcalls.link_calls(calls.where("false"), results.where("false")).count() == 0


@pytest.mark.parametrize("most", [joins.ROWS_PER_TASK, 2])
def test_calls_and_results_that_share_an_id_all_stay(spark, monkeypatch, most):
    monkeypatch.setattr(joins.join_hot_split, "__defaults__", ("inner", most, joins.MOST_HOT, joins.MOST_SALTED))
    texts = ['{"turn":1,"text":"p"}', '{"turn":2,"text":""}', "{bad", None, '{"turn":1,"text":"p"}']
    calls = spark.createDataFrame([(1, "a", None, "reply", t, 0) for t in texts] + [(1, "b", None, "reply", texts[0], 0)], CALL)
    results = spark.createDataFrame([(1, i, c) for i in "abq" for c in ("u", "v", "v", None)], "conv_id long, id string, content string")
    rows = defaultdict(list)
    for r in toolcalls.link_calls(calls, results).collect():
        rows[r["id"]].append((r["status"], r["n_calls"], r["n_results"], r["copies"], r["valid"], json.loads(r["message"]).get("result", "-")))
    key = lambda x: [str(v) for v in x]
    answers = [(1, "u"), (2, "v"), (1, None)]
    asked = [("repeated", 5, 4, 2, True, "-")] + [("repeated", 5, 4, 1, False, "-")] * 3
    assert sorted(rows["a"], key=key) == sorted(asked + [("repeated", 5, 4, n, None, c) for n, c in answers], key=key)
    assert sorted(rows["b"], key=key) == sorted([("ambiguous", 1, 4, n, True, c) for n, c in answers], key=key)
    assert sorted(rows["q"], key=key) == sorted([("orphan", 0, 4, n, None, c) for n, c in answers], key=key)


def test_depth_follows_every_parent(spark):
    pairs = [("a", None), ("b", "a"), ("c", "b"), ("d", "a"), ("d", "c"), ("e", "d"), ("f", "e"), ("f", "b"), ("f", None), ("g", "f"), ("x", "y"), ("y", "x"), ("z", "x"), ("z", "a"), ("w", "z"), ("s", "s")]
    got = {r["id"]: r["depth"] for r in toolcalls.depths(spark.createDataFrame(pairs, "id string, parent string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 6, "x": None, "y": None, "z": None, "w": None, "s": None}


def test_long_chains_are_ordered(spark):
    nodes = spark.range(300).selectExpr("cast(id AS string) AS id", "cast(id - 1 AS string) AS parent")
    assert all(int(r["id"]) == r["depth"] for r in toolcalls.depths(nodes).collect())


def test_given_conversations_are_linked_by_turn(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    turns = {(r["conv_id"], r["turn"]): r for r in rows}
    out = toolcalls.op6_link_tool_calls(spark, SF).collect()
    calls = [r for r in out if r["status"] != "orphan"]
    assert len(calls) == sum(r["role"] != "assistant" for r in rows)
    for r in calls:
        conv, turn = map(int, r["id"].split(":"))
        answer, depth, at = turns.get((conv, turn + 1)), 0, turn - 2
        while (conv, at) in turns and turns[conv, at]["role"] != "assistant":
            depth, at = depth + 1, at - 2
        body = json.loads(r["message"])
        assert r["depth"] == depth and r["valid"] and body["arguments"]["text"] == turns[conv, turn]["text"]
        linked = answer is not None and answer["role"] == "assistant"
        assert (r["status"] == "linked") == linked and body.get("result") == (answer["text"] if linked else None)


def test_shards_move_only_into_the_new_one(spark):
    docs = frame(spark, [(i, "é" * (i % 5)) for i in range(3000)] + [(None, None), (7, "é" * 2)])
    rows = sharding.assign_shards(docs).collect()
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows) and 40 < sum(r["grown_shard"] == 24 for r in rows) < 220
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    assert next(r for r in rows if r["doc_id"] is None)["size"] == 8
    assert sharding.assign_shards(docs.where("false")).count() == 0


def test_shards_follow_weights_and_keep_other_rows_in_place(spark):
    keys = spark.range(4000)
    at = lambda w: {r[0]: r[1] for r in keys.select("id", sharding.rendezvous(keys["id"], 3, w)).collect()}
    even, heavy = at([1, 1, 1]), at([1, 1, 2])
    share = Counter(heavy.values())[2] / 4000
    assert 0.46 < share < 0.54
    assert all(heavy[k] == s or heavy[k] == 2 for k, s in even.items())
    with pytest.raises(ValueError):
        sharding.rendezvous(keys["id"], 2, [1, 0])


def filled(sizes):
    """Targets by resharing until none is above twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        level = left / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over


def test_mix_meets_its_targets(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(0, 900)), str(rng.choice(["a", "b", "Z", "é", "c"], p=[0.6, 0.05, 0.15, 0.1, 0.1]))) for i in range(900)]
    rows += [(1000, "w " * 20000, "b"), (1001, None, "a"), (1002, "w " * 4000, None), (None, "w w", "a")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, block int")
    source = {i: s for i, _, s in rows}
    out = mixing.mix(docs).collect()
    sizes = Counter()
    for _, text, s in rows:
        sizes[s] += len((text or "").split())
    targets, taken = filled(sizes), Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 * max(1, targets[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(out) == len(rows) and all(abs(taken[s] - t) <= 4 * mixing.BLOCK for s, t in targets.items())
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_edges(spark):
    docs = frame(spark, [(1, None), (2, " ")])
    assert [(r["taken"], r["target"]) for r in mixing.mix(docs).collect()] == [(0, 0.0), (0, 0.0)]
    assert mixing.mix(docs.where("false")).count() == mixing.mixed_documents(docs).count() == 0
    same = frame(spark, [(1, "a b"), (1, "a b"), (2, "c d e")])
    assert len(mixing.mix(same).collect()) == 3


def test_schedule_is_even_in_every_stretch(spark):
    targets = spark.createDataFrame([("a", 60000, 3.0, 1, 60000.0), ("b", 40000, 1.0, 2, 20000.0)], "source string, source_size long, weight double, _place int, target double")
    rows = mixing.schedule(spark, targets, 100).orderBy("slot").collect()
    for low in range(0, len(rows) - 100, 50):
        assert 72 <= sum(r["_place"] == 1 for r in rows[low : low + 100]) <= 78


@pytest.mark.parametrize("name", ["op5_template_decontamination", "op10_golden_ratio_mix"])
def test_native_plans(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|ArrowEval|Pandas|Cartesian|NestedLoop", plan)


def test_pipeline_stages_take_effect(spark):
    docs, rows = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "t")
        rows.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    assert rows[0] > rows[1] > rows[2] and rows[3] == rows[4] > 0
    none = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0


def test_rows_with_one_id_or_none_are_dropped_alone(spark):
    docs, labels = planted(spark)
    texts = ["ba be bi", "ba wretchx bo vermink", "so we say one two three today", "", None]
    rows = docs + [(i, t) for t in texts for i in (None, None, 9000)]
    bench = spark.createDataFrame([(5, "one two three")], "item_id long, text string")
    key = lambda r: (str(r[0]), str(r[1]))
    left = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.where("doc_id IS NULL OR doc_id = 9000").collect()), key=key)
    want = lambda drop: sorted(((i, t) for i, t in rows[len(docs) :] if t != texts[drop]), key=key)
    given = frame(spark, rows)
    quiet = toxicity.clean_documents(given, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert left(quiet) == want(1) and quiet.columns == given.columns and quiet.schema.simpleString() == given.schema.simpleString()
    clean = decontaminate.clean_documents(given, bench)
    assert left(clean) == want(2) and clean.columns == given.columns
    flagged = decontaminate.decontaminate(given, bench).where("contaminated").collect()
    assert sorted(str(r["doc_id"]) for r in flagged) == ["9000", "None", "None"]
    halves = frame(spark, [(None, "say one two three four"), (None, "then five six seven eight")])
    long = spark.createDataFrame([(6, "one two three four five six seven eight")], "item_id long, text string")
    assert not decontaminate.decontaminate(halves, long).where("contaminated").count()
