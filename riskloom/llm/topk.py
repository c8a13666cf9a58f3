"""Exact top-k search: term-at-a-time accumulation of postings into dense score arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table

K = 5
#: Rows of a candidate block, queries of a query block, query rows scored together.
BLOCK = 2048
QUERIES = 512
ROWS = 64
#: Blocks that a reader decodes at once.
READ = 4
LOWEST = np.iinfo(np.int64).min


def quantised(vector: str) -> Column:
    """floor(256 * x) of each component as a double."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(vector: str) -> Column:
    """Not null, and neither a null nor a non-finite component."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _pack(ids: np.ndarray, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> dict:
    """Postings by term: for each term the rows that have it and their weights."""
    order = np.lexsort((rows, terms))
    terms, starts = np.unique(terms[order], return_index=True)
    ends = np.append(starts[1:], len(rows)).astype(np.int64)
    parts = {"ids": ids, "terms": terms, "ends": ends, "rows": rows[order], "weights": weights[order]}
    return {k: np.asarray(v, np.int64).tobytes() for k, v in parts.items()}


PACK = "ids binary, terms binary, ends binary, rows binary, weights binary"


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Ids, and row, term and weight of each component that is not 0."""
    vectors = batch.column("v")
    lengths = np.diff(np.asarray(vectors.offsets))
    weights = np.asarray(vectors.flatten(), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = weights != 0
    return np.asarray(batch.column("vec_id"), np.int64), rows[some], terms[some], weights[some]


def _packed(size: int):
    """Batches to packs of up to ``size`` rows, ids ascending in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                part = part.take(pa.array(np.argsort(np.asarray(part.column("vec_id"), np.int64), kind="stable")))
                yield pa.RecordBatch.from_pylist([_pack(*_postings(part))])

    return run


def _unpack(row: dict, prefix: str) -> dict[str, np.ndarray]:
    return {k: np.frombuffer(row[prefix + k], np.int64) for k in ("ids", "terms", "ends", "rows", "weights")}


def best(q: dict, c: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, candidate row and score of each query's ``k`` best candidates in a block.

    Every query row has a dense array of scores; a term that both sides know scatters its
    weighted postings into it. Ids ascend in a block, so the first of equal scores is the
    smaller id.
    """
    at = {t: i for i, t in enumerate(c["terms"].tolist())}
    c_from = np.append(0, c["ends"][:-1])
    q_from = np.append(0, q["ends"][:-1])
    shared = [(i, at[t]) for i, t in enumerate(q["terms"].tolist()) if t in at]
    width, found = len(c["ids"]), []
    lists = {j: (c["rows"][c_from[j] : c["ends"][j]], c["weights"][c_from[j] : c["ends"][j]]) for _, j in shared}
    for j, (cols, v) in lists.items():
        if 4 * len(cols) >= width:  # adding a few noughts costs less than scattering the others
            every = np.zeros(width, np.int64)
            every[cols] = v
            lists[j] = None, every
    for low in range(0, len(q["ids"]), ROWS):
        scores = np.zeros((min(ROWS, len(q["ids"]) - low), width), np.int64)
        for i, j in shared:
            rows = q["rows"][q_from[i] : q["ends"][i]]
            a, b = np.searchsorted(rows, (low, low + ROWS))
            rows, w = rows[a:b] - low, q["weights"][q_from[i] + a : q_from[i] + b, None]
            cols, v = lists[j]
            if cols is None and 2 * len(rows) >= len(scores):
                every = np.zeros((len(scores), 1), np.int64)
                every[rows] = w
                scores += every * v
            elif cols is None:
                scores[rows] += w * v
            else:
                scores[rows[:, None], cols] += w * v
        own = c["ids"] == q["ids"][low : low + ROWS, None]
        scores[own] = LOWEST
        if width > k:
            edge = np.partition(scores, width - k, axis=1)[:, width - k, None]
            over, level = scores > edge, scores == edge
            take = over | (level & (np.cumsum(level, axis=1) <= k - over.sum(axis=1, keepdims=True)))
        else:
            take = np.ones_like(own)
        r, col = np.nonzero(take & ~own)
        found.append((r + low, col, scores[r, col]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best of two lists of query rows, candidate ids and scores, for each query row."""
    rows, ids, scores = (np.concatenate(x) for x in zip(a, b))
    order = np.lexsort((ids, ~scores, rows))  # ~ turns the order without overflow
    rows = rows[order]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    kept = order[place < k]
    return rows[place < k], ids[kept], scores[kept]


def _search(k: int):
    """Pairs of blocks to the ``k`` best candidates that a task has met, for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                q, c = _unpack(row, "q_"), _unpack(row, "")
                r, col, score = best(q, c, k)
                found = r, c["ids"][col], score
                ids, before = held.get(row["q"], (q["ids"].copy(), None))
                held[row["q"]] = ids, found if before is None else _merged(before, found, k)
        for ids, (r, found, score) in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def _blocks(rows: DataFrame, size: int, label: str) -> DataFrame:
    """Stored packs of ``size`` rows, a few in each part that a reader decodes at once."""
    return stored(rows.mapInArrow(_packed(size), PACK), label, **{"parquet.block.row.count.limit": READ})


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """Each query's ``k`` highest inner products: query_id, rank, vec_id, score.

    Both sides have vec_id and v, an array of whole numbers (position = term; 0 and missing
    positions are in no posting). Both are stored in blocks, and a task reads some of either side:
    nothing is broadcast and no block is shuffled. A pair of blocks is scored in one piece of
    bounded size, and only k rows per query and task are shuffled to be merged.

    A row never finds candidates of its own id; a query id given twice counts once, with its
    smallest vector. Candidates given twice are found twice. Rows without an id take no
    part. Empty vectors score 0. Either side empty gives an empty result. Products must
    fit a 64-bit number.
    """
    ids = queries.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"))
    ids = stored(ids, "queries")
    blocks = max(1, -(-ids.count() // QUERIES))
    spread = ids.repartition(blocks, "vec_id")
    q = _blocks(spread, QUERIES, "query-blocks").select(
        F.monotonically_increasing_id().alias("q"), *[F.col(x.split()[0]).alias("q_" + x.split()[0]) for x in PACK.split(", ")]
    )
    c = _blocks(candidates.where("vec_id IS NOT NULL").select("vec_id", "v"), BLOCK, "candidate-blocks")
    pairs = c.hint("shuffle_replicate_nl").crossJoin(q)  # by pairs of partitions, whatever their sizes
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").where(usable("embedding"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), quantised("embedding").alias("v"))
    return top_k(rows.where("vec_id % 50 = 0"), rows)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
