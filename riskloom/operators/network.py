"""Weights of a feed-forward network by L-BFGS: a job per evaluation, matrix products in its tasks.

The network is that of ``MultilayerPerceptronClassifier`` (logistic hidden layers, softmax, mean cross
entropy, weights in the same order), but rows have weights, where that learner wants a row repeated.
Tasks read many rows as one byte string, inputs as single floats; only sums of the slopes, as many as
weights, leave them, added up as doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows in one packed row, rows that a task multiplies at a time, and rows a task is meant for.
ROWS_PACKED, ROWS_AT_ONCE, ROWS_PER_TASK = 4096, 2048, 250_000
#: Steps that L-BFGS looks back, evaluations along one step, and the gain that ends a fit.
MEMORY, TRIES, TOLERANCE = 10, 20, 1e-6


#: A packed row: inputs, label and weight of its rows, as bytes.
PACKED = {"x": np.float32, "y": np.float64, "w": np.float64}


def packed_rows(df: DataFrame, label: str, weight: str) -> DataFrame:
    """``features``, label and weight, with some ROWS_PACKED rows in one: x, y, w as bytes.

    Dealt evenly over as many tasks as cores, or a multiple. The caller persists the frame, which keeps
    the tasks as they are; files would be joined by their size, some tasks getting twice the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def packed(whole: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(kept).combine_chunks()
            kept.clear()
            for at in range(0, rows.num_rows, ROWS_PACKED):
                some = rows.slice(at, ROWS_PACKED)
                if some.num_rows < ROWS_PACKED and not whole:
                    kept.extend(some.to_batches())
                    break
                values = (some.column("x").combine_chunks().flatten(), some.column("y"), some.column("w"))
                told = [pa.array([v.to_numpy().astype(kind).tobytes()], pa.binary()) for v, kind in zip(values, PACKED.values())]
                yield pa.RecordBatch.from_arrays(told, list(PACKED))

        for batch in batches:
            kept += [batch] if batch.num_rows else []
            if sum(b.num_rows for b in kept) >= ROWS_PACKED:
                yield from packed(False)
        if kept:
            yield from packed(True)

    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))
    count = df.count()
    tasks = min(-(-count // ROWS_PACKED), cores * -(-count // (cores * ROWS_PER_TASK)))
    return rows.mapInArrow(run, "x binary, y binary, w binary").repartition(max(1, tasks))


def _layers(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per layer the matrix, a row per input, and the constants."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def loss_and_slopes(weights: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over some rows, as one array: weight, loss, and the slope of the loss in each network weight."""
    parts = _layers(weights.astype(x.dtype), layers)
    out = np.zeros(2 + len(weights))
    out[0] = w.sum()
    slopes = _layers(out[2:], layers)
    seen = [x]
    with np.errstate(over="ignore"):
        for matrix, constants in parts[:-1]:
            z = seen[-1] @ matrix
            z += constants
            np.exp(np.negative(z, out=z), out=z)
            z += 1.0
            seen.append(np.reciprocal(z, out=z))
    z = seen[-1] @ parts[-1][0] + parts[-1][1]
    z -= z.max(axis=1, keepdims=True)
    logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    here = (np.arange(len(y)), y.astype(np.intp))
    out[1] = -(w * logs[here]).sum()
    back = np.exp(logs)
    back[here] -= 1.0
    back *= w[:, None].astype(x.dtype)
    for k in range(len(parts) - 1, -1, -1):
        slopes[k][0][...] = seen[k].T @ back
        slopes[k][1][...] = back.sum(axis=0)
        if k:
            back = back @ parts[k][0].T
            back *= seen[k]
            back *= np.subtract(1.0, seen[k], out=seen[k])
    return out


def evaluate(rows: DataFrame, layers: Sequence[int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted mean loss over the packed rows, and its slopes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + len(weights))
        for batch in batches:
            for k in range(batch.num_rows):
                x, y, w = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in PACKED.items())
                x = x.reshape(len(y), -1)
                for at in range(0, len(y), ROWS_AT_ONCE):
                    s = slice(at, at + ROWS_AT_ONCE)
                    total += loss_and_slopes(weights, layers, x[s], y[s], w[s])
        if total[0]:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["one", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist()], axis=0)
        return pa.table({"one": table.column("one").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "one int, sums binary"
    # One row, collected: first() would end the Python workers, which take longer to start than to add up.
    found = rows.mapInArrow(run, schema).repartition(1, "one").groupBy("one").applyInArrow(add, schema).collect()
    if not found:
        raise ValueError("no rows to fit the network on")
    sums = np.frombuffer(found[0]["sums"], np.float64)
    return float(sums[1] / sums[0]), sums[2:] / sums[0]


def _direction(slopes: np.ndarray, moves: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill, bent by the last (step, change of slopes) pairs."""
    out, shares = -slopes, []
    for s, d in reversed(moves):
        shares.append((s @ out) / (s @ d))
        out = out - shares[-1] * d
    if moves:
        s, d = moves[-1]
        out = out * ((s @ d) / (d @ d))
    for (s, d), share in zip(moves, reversed(shares)):
        out = out + (share - (d @ out) / (s @ d)) * s
    return out


@dataclass
class Descent:
    """Where L-BFGS stands, and its last (step, change of slopes) pairs."""

    point: np.ndarray
    loss: float
    slopes: np.ndarray
    moves: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


def descent(look: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray) -> Descent:
    """The start of L-BFGS; ``look`` gives loss and slopes."""
    return Descent(start, *look(start))


def go_on(look: Callable[[np.ndarray], tuple[float, np.ndarray]], at: Descent, steps: int) -> None:
    """Take ``at`` on by ``steps`` steps, or fewer if the loss falls no more; then the pairs are dropped.

    A step must lower the loss by a share of what its slope promises, and take most of that slope away.
    """
    for _ in range(steps):
        ahead = _direction(at.slopes, at.moves)
        steep = at.slopes @ ahead
        if not steep < 0:
            break
        size, low, high, found = 1.0 if at.moves else min(1.0, 1.0 / np.linalg.norm(at.slopes)), 0.0, np.inf, None
        for _ in range(TRIES):
            there = look(at.point + size * ahead)
            if not there[0] <= at.loss + 1e-4 * size * steep:
                high = size
            else:
                if found is None or there[0] < found[1][0]:
                    found = size, there
                if there[1] @ ahead >= 0.9 * steep:
                    break
                low = size
            size = 2 * size if np.isinf(high) else (low + high) / 2
        if found is None:
            break
        size, (loss, slopes) = found
        move, bent = size * ahead, slopes - at.slopes
        if move @ bent > 1e-12 * (bent @ bent) ** 0.5 * (move @ move) ** 0.5:
            at.moves = [*at.moves, (move, bent)][-MEMORY:]
        gain, at.point, at.loss, at.slopes = at.loss - loss, at.point + move, loss, slopes
        if gain <= TOLERANCE * max(abs(loss), 1e-6):
            break
    else:
        return
    at.moves = []


def descend(look: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int) -> np.ndarray:
    """The point after ``steps`` steps of L-BFGS, or fewer if the loss falls no more."""
    at = descent(look, start)
    go_on(look, at, steps)
    return at.point
