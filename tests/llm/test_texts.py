"""Jaccard join, substring removal, decontamination."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import decontaminate, jaccard, repeats
from riskloom.llm.fmindex import FMIndex
from tests.conftest import SF
from tests.llm.test_models import frame

WORDS = np.array("ab cd ef gh ij kl mn op qr st uv wx yz".split())


def say(rng, n):
    return " ".join(rng.choice(WORDS, n))


def brute_links(rows, n=5, threshold=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set())
    root, links = list(range(len(rows))), Counter()
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return [(rows[k][0], rows[root[k]][0], links[k]) for k in range(len(rows))]


def test_depth_reaches_the_recall():
    d = jaccard.depth_for(0.8, 0.999, 24)
    assert 1 - (1 - 0.8**d) ** 24 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 24


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows, base = [], say(rng, 120).split()
    for i in range(40):  # one group of near copies in several blocks
        w = list(base)
        for _ in range(i % 4):
            w[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, say(rng, 60)) for i in range(20)]
    rows += [(200, "one two"), (201, "ONE two"), (202, "a"), (203, "a b c d e"), (204, "a b c d f")]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (c, n) for i, c, n in brute_links(rows)}


def test_jaccard_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: (c, n) for i, c, n in brute_links(rows)}


def test_jaccard_edges(spark):
    rows = [(1, None), (2, ""), (3, "  "), (7, "p q r s t u"), (5, "p q r s t u"), (5, "p q r s t u"), (None, "lone text")]
    got = sorted((str(r["doc_id"]), r["copy_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect())
    assert got == [("1", 1, 1, 0), ("2", 2, 2, 0), ("3", 3, 3, 0), ("5", 5, 5, 2), ("5", 5, 5, 2), ("7", 5, 5, 2), ("None", None, None, 0)]
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    kept = jaccard.one_per_class(frame(spark, rows))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5", "None"]
    assert kept.columns == frame(spark, rows).columns


def brute_cut(rows, width):
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        keep = [True] * len(words)
        for a in range(len(words) - width + 1):
            t = tuple(words[a : a + width])
            if t in seen:
                keep[a : a + width] = [False] * width
            seen.add(t)
        left = " ".join(w for w, k in zip(words, keep) if k)
        out[i] = (len(words), keep.count(False), hashlib.sha256(left.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 20])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD", 500)
    rng = np.random.default_rng(4)
    passage = say(rng, 40)
    rows = [(i, f"{say(rng, int(rng.integers(0, 50)))} {passage if i % 3 == 0 else ''} {say(rng, 20)}") for i in range(60)]
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, "a b c " * 60), (103, "z " * 90), (104, " ".join(rows[3][1].split()[:30]))]
    rows += [(105, ""), (106, "x y"), (107, "x y")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.cut_repeats(frame(spark, rows), width=8).collect()}
    assert got == brute_cut(rows, 8)


def test_repeats_edges(spark):
    text = say(np.random.default_rng(0), 30)
    rows = [(None, text), (4, text), (4, text), (9, None)]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in repeats.cut_repeats(frame(spark, rows)).collect())
    assert got == [("4", 30, 0), ("4", 30, 0), ("9", 0, 0), ("None", 30, 30)]
    assert repeats.cut_repeats(frame(spark, [])).count() == 0


def test_index_finds_earlier_windows():
    rng = np.random.default_rng(9)
    texts = [rng.integers(1, 4, int(rng.integers(3, 40))) for _ in range(50)]
    fm, size = FMIndex(texts, 5), np.array([len(t) for t in texts])
    got = fm.earlier(texts, np.cumsum(size + 1) - size - 1)
    seen = set()
    for t, hit in zip(texts, got):
        for a in range(len(t) - 4):
            w = tuple(t[a : a + 5])
            assert hit[a] == (w in seen)
            seen.add(w)


QUESTION = "A farmer drives 40 km with Alice and then 3 hours later he drives the same 40 km back to the village"


def found(spark, texts, items=((1, QUESTION), (2, "too short"), (3, None))):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    docs = frame(spark, list(enumerate(texts)))
    return {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}


def test_changed_questions_are_found_if_their_values_are_consistent(spark):
    same = "Before all that. " + QUESTION + " And more."
    changed = QUESTION.replace("40 km", "75 miles").replace("Alice", "Robert").replace("3 hours", "8 hours")
    broken = QUESTION.replace("40 km back", "41 km back")
    cased = QUESTION.replace("A farmer", "a FARMER,").replace(" and ", "  and\n")
    plain = "A baker walks far with his dog and then much later he walks home to eat"
    got = found(spark, [same, changed, broken, cased, plain, "", None, QUESTION[:30]])
    assert [got[i]["contaminated"] for i in range(8)] == [True, True, False, True, False, False, False, False]
    assert not got[0]["reparameterised"] and got[1]["reparameterised"]


def test_glued_values_do_not_shift_the_others(spark):
    item = "so there he told us that Anna had bought 2 old books and 7 pens before Anna gave 2 of them to Bert and kept 7 for the long way home"
    other = item.replace("Anna", "Olga").replace("2", "5")
    before = ["In the 19th year. ", "A 10-year-old said. ", "After covid-19 came. ", "Pages 5-10 say. ", "On my YouTube. ", "The G20 in town. ", "Pay 40\u20ac-50 or 3rd, 4th and 5th. "]
    texts = [b + item for b in before] + [b + other for b in before]
    got = found(spark, texts, ((1, item),))
    assert [got[i]["best_cover"] for i in range(len(texts))] == [1.0] * len(texts)
    assert [got[i]["reparameterised"] for i in range(len(texts))] == [False] * len(before) + [True] * len(before)


def test_glued_values_must_map_one_to_one(spark):
    item = "in the 19th year they sold it and in the 19th year they got it"
    texts = [item.replace("19th", "20th"), item.replace("19th", "20th", 1)]
    got = found(spark, texts, ((1, item),))
    assert [got[i]["contaminated"] for i in range(2)] == [True, False]


def test_windows_without_slots_count_beside_inconsistent_values(spark):
    plain = "so we went down the old road to the mill and saw that no one was there at all"
    item = plain + " but 4 of us and 4 of them"
    got = found(spark, [item.replace("4 of them", "5 of them"), "we saw 4 of us and 5 of them"], ((1, item),))
    assert got[0]["contaminated"] and not got[0]["reparameterised"] and not got[1]["contaminated"]


def test_given_benchmark_passages_are_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [" ".join(r["text"].split()) for r in bench.collect()]
    truth = {r["doc_id"] for r in docs.collect() if any(x in " ".join(r["text"].split()) for x in items)}
    out = decontaminate.decontaminate(docs, bench).collect()
    assert {r["doc_id"] for r in out if r["contaminated"]} == truth and len(out) == docs.count()


def test_decontamination_edges(spark):
    assert not found(spark, ["x"], [(None, None)])[0]["contaminated"]
    assert found(spark, []) == {}
    short = found(spark, ["so we say one two three today", "nothing"], [(5, "one two three"), (6, "one two three")])
    assert (short[0]["first_item"], short[0]["n_items"], short[1]["contaminated"]) == (5, 1, False)


def test_no_python_in_the_plan(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = decontaminate.decontaminate(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_words_are_those_of_the_pattern():
    text = "a\x1cb\x85c d\x0be"
    assert len(text.encode().split()) == len(re.findall(r"[^\x20\x09-\x0D]+", text)) == 3
