"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, node string, words long, last boolean"


def talk(spark, rows):
    """Conversations with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "n", 2, True) for r in rows], SCHEMA)


def ordered(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        if c is not None:
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, m in members.items():
        under = [k for k in members if k[: len(node)] == node]
        kids = [k for k in under if len(k) == len(node) + 1]
        leaves = [k for k in under if not any(x[: len(k)] == k and len(x) > len(k) for x in under)]
        saved = sum((len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in under if k)
        done = ",".join(str(c) for c in m if len(convs[c]) == len(node))
        out.append((m[0], len(node), min(members[node[:-1]]) if node else None, len(m), len(kids), len(leaves), saved, hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_talk(seed, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-30, 200), n, replace=False).tolist():
        for k in range(int(rng.integers(1, 8))):
            rows.append((c, [k, None][int(rng.integers(0, 9)) == 0], ["user", "bot", None][int(rng.integers(0, 3)) if k else 0], f"w{int(rng.integers(0, 2))} and\tso"))
    return rows


@pytest.mark.parametrize("limit,shard", [(None, trie.SHARD), (1, 5), (4, 3), (10**6, 1)])
def test_trie_equals_brute_force(spark, limit, shard):
    rows = some_talk(7)
    turns, sizes = trie.branched(trie.ordered_turns(talk(spark, rows)))
    assert shown(trie.prefix_trie(turns, sizes, limit, shard)) == brute(rebuilt(ordered(rows)))


def test_long_conversations_are_numbered_and_summed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "TURNS", 4)
    rows = [(c, t, "user", f"turn {t}") for c in (20, 21, 33, 40) for t in range(25 + c % 3)]
    rows += [(50, 3, "user", x) for x in ("same", "same", "b", "c", None)] + [(50, None, None, None), (50, None, "user", "")]
    turns, sizes = trie.branched(trie.ordered_turns(talk(spark, rows)))
    assert shown(trie.prefix_trie(turns, sizes, 2)) == brute(rebuilt(ordered(rows)))


def test_edges(spark):
    """Turnless conversations, missing ids, equal conversations, ids far apart, an empty table."""
    rows = [(None, 0, "user", "lost"), (7, 0, "user", "x"), (-3, 0, "a", "y"), (5 * 10**12, 0, "a", "y"), (10**9, 0, "a", "y"), (11, 0, "a", "word " * 50_000)]
    rows += [(c, t, "user", "copy") for c in range(100, 160) for t in range(3)]
    turns, sizes = trie.branched(trie.ordered_turns(talk(spark, rows)))
    want = brute(rebuilt(ordered(rows)))
    assert any(r[1] == 0 for r in want) and shown(trie.prefix_trie(turns, sizes)) == want
    none = trie.branched(trie.ordered_turns(talk(spark, [])))
    assert trie.prefix_trie(*none).count() == 0


def test_perfect_hash_gives_each_key_its_own_slot():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        keys = rng.integers(0, 2**63, (n, 2)).astype(np.uint64)
        found = trie.PerfectHash(keys)
        assert sorted(found.slots(keys).tolist()) == list(range(n))
        assert (found.slots(rng.integers(0, 2**63, (50, 2)).astype(np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        trie.PerfectHash(np.ones((2, 2), np.uint64))


def test_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 10)
    ids = list(range(-25, 95, 3))
    members = spark.createDataFrame([(b"n" * 16, i) for i in ids] + [(b"m" * 16, 5)], "node binary, conv_id long")
    got = {bytes(r["node"]): r["ends_sha256"] for r in trie.ends(members).collect()}
    assert got == {b"n" * 16: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m" * 16: hashlib.sha256(b"5").hexdigest()}
