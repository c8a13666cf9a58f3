"""Periodic runs of words: suffix trees of a text and its reversal, extended Lyndon roots.

A run is a stretch of words with smallest period q, at least ``times`` periods and ``least``
words long, that no neighbouring word extends. Every run holds a root that is the longest
Lyndon word at its place, for the order of the words or for its reverse. So the longest
Lyndon words of both orders are candidates, each extended to both sides by the longest common
extension of its start and the place behind it: forward in the tree of the words,
backward in the tree of the reversed ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import WORD, table
from riskloom.llm.suffixtree import Extension, SuffixTree

#: Words and periods a run has at least.
LEAST, TIMES = 6, 4
#: Rounds in which stretches are narrowed before their trees are built.
ROUNDS = 8
#: Bytes of text after which results are handed on.
FLUSH = 16_000_000


def stretches(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """Parts of ``words`` that may hold runs; no run lies, wholly or partly, outside them.

    A run of ``times`` periods holds each of its words that often, and so does every stretch
    around it. Words that are rarer in their stretch cut it, and what is left is looked at again.
    """
    at = np.flatnonzero(np.bincount(words)[words] >= times) if len(words) else np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        if not len(at):
            return
        group = np.cumsum(np.r_[False, np.diff(at) > 1])
        _, which, count = np.unique(group * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        keep = (np.bincount(group)[group] >= least) & (count[which] >= times)
        if keep.all():
            break
        at = at[keep]
    if len(at):
        cut = np.flatnonzero(np.diff(at) > 1)
        for a, b in zip(np.r_[0, cut + 1], np.r_[cut, len(at) - 1]):
            yield int(at[a]), int(at[b]) + 1


def lyndon_lengths(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next smaller suffix."""
    n = len(rank) - 1
    out, stack = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        mine = rank[i]
        while rank[stack[-1]] > mine:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, period, length) of the runs, by start, then period. ``times`` is at least 2."""
    found = []
    for lo, hi in stretches(words, least, times):
        part = words[lo:hi]
        n = len(part)
        tree = SuffixTree(part.tolist())
        forward, backward = Extension(tree), Extension(SuffixTree(part[::-1].tolist()))
        for descending in (False, True):
            period = lyndon_lengths(tree.ranks(descending))
            i = np.arange(n)
            behind = i + period
            end = behind + forward(i, behind)
            start = i - backward(n - i, n - behind)
            run = (end - start >= least) & (end - start >= times * period)
            found.append(np.stack([start[run] + lo, period[run], (end - start)[run]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _search(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        names = ["doc_id", "n_words", "runs", "collapsed"]
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), kind, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = text.as_py().split()
                numbers: dict[bytes, int] = {}
                found = runs_of(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), least, times)
                n = len(words)
                if len(found):
                    start, period, length = found.T
                    again = np.zeros(n + 1, np.int64)
                    np.add.at(again, start + period, 1)
                    np.add.at(again, start + length, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(again[:n]) == 0)]
                rows.append((doc_id, n, [{"start": s, "length": m, "period": q} for s, q, m in found.tolist()], b" ".join(words)))
                held += len(rows[-1][3]) + 24 * len(found) + 64
                if held >= FLUSH:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return run


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period), collapsed.

    ``collapsed`` is the text, its words joined by one space, without the words that lie in a run
    behind its first period. Runs come by start, then period. Each text is searched by itself
    in the task that reads it, without a shuffle; its memory is that of its stretches' trees,
    linear in their words.

    A null text has no words. Ids may be null or repeat: each row has its own result. Texts of
    any length are searched whole. An empty table gives an empty result. Other columns are not
    looked at.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two or more periods and at least one word")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return rows.mapInArrow(_search(least, times), schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; then the first one."""

    def better(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(F.signum(a["period"] - b["period"]).cast("int"))

    return F.get(F.array_sort(runs, better), F.lit(0))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs``, where each tenth text (by the CRC-32 of its id) repeats a stretch of words from some
    word on. A null id counts as an empty text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("_h")).select(
        "doc_id", "text", F.floor(F.col("_h") / 10).alias("_g"),
        F.when(F.col("_h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).alias("_words"),
    )
    placed = chosen.withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    placed = placed.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    again = F.expr("array_join(transform(_words, (w, i) -> if(i < _a, w, element_at(_words, cast(1 + _a + (i - _a) % _p as int)))), ' ')")
    return placed.select("doc_id", F.when(F.col("_a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(repeated_tails(table(spark, sf_dir, "documents", "doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), strongest(F.col("runs")).alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    best = F.col("best")
    return found.select(
        "doc_id", "n_runs", best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


ORACLE = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), hashed AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
      range(len(coalesce(doc_id::VARCHAR, ''))), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM documents, crc_table
), placed AS (
  SELECT doc_id, r, words, len(words) AS n, h, (h // 10) AS g, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM hashed
), said AS (
  SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] END)
    ELSE words END AS words FROM placed
), word AS (
  SELECT r, unnest(words) AS w, unnest(range(n)) AS i FROM said
), usual AS (
  SELECT * FROM word SEMI JOIN (SELECT r, w FROM word GROUP BY r, w HAVING count(*) >= {TIMES}) AS c ON word.r = c.r AND word.w = c.w
), same AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM usual AS x JOIN usual AS y ON x.r = y.r AND x.w = y.w AND y.i > x.i
), island AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM same) GROUP BY r, q, part
), long AS (
  SELECT * FROM island WHERE length >= greatest({LEAST}, {TIMES} * q)
), run AS (
  SELECT * FROM long ANTI JOIN long AS s ON long.r = s.r AND s.q < long.q AND s.start <= long.start AND s.start + s.length >= long.start + long.length
), told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM run GROUP BY r
), ratio AS (
  SELECT a.r, a.start, a.length, a.q, row_number() OVER (PARTITION BY a.r ORDER BY a.better, a.start, a.q) AS k FROM (
    SELECT x.r, x.start, x.length, x.q, count(*) FILTER (WHERE y.length * x.q > x.length * y.q) AS better
    FROM run AS x JOIN run AS y ON x.r = y.r GROUP BY x.r, x.start, x.length, x.q) AS a
), gone AS (
  SELECT r, list(DISTINCT p) AS places FROM (SELECT r, unnest(range(start + q, start + length)) AS p FROM run) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, ratio.start::BIGINT AS start, ratio.length::BIGINT AS length, ratio.q::BIGINT AS period,
  (1000 * ratio.length // ratio.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words ELSE
    list_transform(list_sort(list_filter(range(n), lambda i: NOT list_contains(places, i))), lambda i: words[i + 1]) END, ' '), '')) AS collapsed_sha256
FROM said LEFT JOIN told ON said.r = told.r LEFT JOIN ratio ON said.r = ratio.r AND ratio.k = 1 LEFT JOIN gone ON said.r = gone.r
"""
