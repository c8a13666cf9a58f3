"""Suffix trees and periodic runs against brute force."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import periods
from riskloom.llm.suffixtree import SPAN, Extension, RangeMinimum, SuffixTree
from tests.llm.test_models import frame


def brute_runs(w, least, times):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            inside = any(s <= i and s + m >= i + length for s, p, m in out if p < q)
            if j > i and length >= max(least, times * q) and not inside:
                out.append((i, q, length))
            i = max(j, i + 1)
    return sorted(out)


def sequences(count, seed):
    rng = np.random.default_rng(seed)
    for k in range(count):
        n = int(rng.integers(0, 90))
        w = rng.integers(0, int(rng.integers(1, 6)), n).tolist()
        if k % 3 == 0 and n:  # a tail that repeats
            a, p = int(rng.integers(0, n)), int(rng.integers(1, 9))
            w = [w[i] if i < a or a + (i - a) % p >= n else w[a + (i - a) % p] for i in range(n)]
        yield np.array(w, np.int64)


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_brute_force(least, times):
    for w in sequences(250, least):
        assert [tuple(r) for r in periods.runs_of(w, least, times).tolist()] == brute_runs(w.tolist(), least, times)


def test_extension_is_the_shared_prefix_and_ranks_are_the_suffix_order():
    for w in sequences(60, 9):
        s, n = w.tolist(), len(w)
        tree = SuffixTree(s)
        i, j = (a.ravel() for a in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while a + k < n and b + k < n and s[a + k] == s[b + k]:
                k += 1
            want.append(k)
        assert Extension(tree)(i, j).tolist() == want
        for descending in (False, True):
            key = {k: [-x if descending else x for x in s[k:]] for k in range(n + 1)}
            assert [sorted(key, key=key.get).index(k) for k in key] == tree.ranks(descending)


def test_range_minimum_over_many_blocks():
    rng = np.random.default_rng(5)
    for n in (1, SPAN, 5 * SPAN + 3, 40 * SPAN):
        v = rng.integers(0, 1000, n).astype(np.int32)
        lo, hi = np.sort(rng.integers(0, n, (2, 500)), axis=0)
        assert RangeMinimum(v).least(lo, hi).tolist() == [int(v[a : b + 1].min()) for a, b in zip(lo, hi)]


def test_stretches_keep_every_run_and_drop_ordinary_text():
    rng = np.random.default_rng(6)
    assert list(periods.stretches(rng.integers(0, 4000, 5000))) == []
    for w in sequences(100, 7):
        kept = list(periods.stretches(w))
        for start, _, length in brute_runs(w.tolist(), 6, 4):
            assert any(lo <= start and start + length <= hi for lo, hi in kept)


def test_find_runs_edges(spark):
    """Nulls, empty texts, repeated and missing ids, a long text, columns of any name."""
    long = " ".join(["start", *["one two three"] * 20_000, "end"])
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a b a b a b a b"), (4, "a b a b a b a b"), (None, "x x x x x x y"),
        (5, "x x x x x"), (6, long), (7, "p q r " * 3 + "p q"), (8, "a\u00a0b " * 6 + "Z Z Z Z Z Z Z"),
    ]
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"]).decode()) for r in periods.find_runs(frame(spark, rows)).collect())
    assert got == [
        ("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""), ("4", 8, [(0, 8, 2)], "a b"), ("4", 8, [(0, 8, 2)], "a b"),
        ("5", 5, [], "x x x x x"), ("6", 60_002, [(1, 60_000, 3)], "start one two three end"), ("7", 11, [], "p q r p q r p q r p q"),
        ("8", 13, [(0, 6, 1), (6, 7, 1)], "a\u00a0b Z"), ("None", 7, [(0, 6, 1)], "x y"),
    ]
    assert periods.find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(frame(spark, rows), times=1)


def test_strongest_run_and_ties(spark):
    runs = [[(5, 12, 3), (0, 8, 2), (9, 9, 2)], [(4, 8, 2), (1, 8, 2)], [(1, 12, 3), (1, 8, 2)], [(0, 10**9 + 1, 10**8), (7, 10**9, 10**8)], []]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(runs)], "k int, runs array<struct<start:long,length:long,period:long>>")
    got = {r["k"]: r["best"] and tuple(r["best"]) for r in df.select("k", periods.strongest(F.col("runs")).alias("best")).collect()}
    assert got == {0: (9, 9, 2), 1: (1, 8, 2), 2: (1, 8, 2), 3: (0, 10**9 + 1, 10**8), 4: None}


def test_repeated_tails_of_null_and_empty_texts(spark):
    rows = [(i, t) for i in range(200) for t in (None, "", "a b c d e f g h i j k l")]
    got = periods.repeated_tails(frame(spark, rows)).collect()
    assert len(got) == 600 and sum(r["text"] is None for r in got) == 200
    changed = {r["doc_id"] for r in got if r["text"] not in (None, "", "a b c d e f g h i j k l")}
    assert changed and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)
