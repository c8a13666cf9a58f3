"""Language-model scoring by Brown classes: exchange clustering and class bigrams.

Every word of the training texts is a unit. Exchange clustering puts units into classes so that
the class of a word tells most about the next one's. A token's probability is

    P(class | class before) * P(word | class)

with additive smoothing in each factor, so that the probabilities of all words, unseen ones
included, add up to 1. Unseen words are one unit per ending, in the class of most tokens of the
rare words with that ending.

Frequent words, of which there are few, are moved one after the other; their counts are dense. The
others lie in blocks of units with the neighbours of each of their tokens; a task moves a block's
units side by side. Tasks receive the class of every unit, a byte each.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table

#: Share of all training tokens from which a word is frequent, or unseen words with an ending have
#: a unit of their own. At most 1 / SHARE of either kind can exist.
SHARE = 5e-5
#: Classes (class 0 is the end of a text), exchange passes, words of an ending.
CLASSES, PASSES, ENDING = 48, 10, 2
SMOOTH = 0.5
#: Tokens of a chunk, which shares one dictionary; frequent units per block when counts are summed.
CHUNK, BLOCK = 2_000_000, 512
#: Rare units of a block (two bytes number them); those whose gains are added up at a time; counts of
#: a neighbour's class up to which gains are looked up.
RARE_BLOCK, RARE_AT_ONCE, FEW = 16_384, 1024, 32
FOLDS, HELD_OUT = 7, 2
END, REST = 0, 1


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to chunks: one row with the words, their training counts and all tokens.

    A chunk ends after the document that fills it. Words are bytes between ASCII blanks,
    with A-Z lower-cased.
    """
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("ends", pa.binary()),
         ("codes", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("n_train", pa.int64())]
    )
    task = TaskContext.get().partitionId() << 24

    def flush() -> pa.RecordBatch:
        x, stop = np.frombuffer(codes, np.int32), np.asarray(ends, np.int64)
        trained = np.repeat(~np.asarray(held, bool), np.diff(stop, prepend=0))
        n = np.bincount(x[trained], minlength=len(ids))
        words = pa.array([w.decode("utf-8", "replace") for w in ids], pa.string())
        row = [[task + made], [doc_ids], [held], [stop.tobytes()], [x.tobytes()]]
        arrays = [pa.array(v, f.type) for v, f in zip(row, schema)]
        arrays += [pa.ListArray.from_arrays([0, len(ids)], words), pa.ListArray.from_arrays([0, len(ids)], pa.array(n, pa.int64()))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([int(trained.sum()) + held.count(False)], pa.int64())], schema=schema)

    made, doc_ids = 0, []
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts):
            if not doc_ids:
                ids, codes, ends, held = defaultdict(count().__next__), array("i"), [], []
            codes.extend(map(ids.__getitem__, text.as_py().lower().split()))
            doc_ids.append(doc_id)
            held.append(out)
            ends.append(len(codes))
            if len(codes) >= CHUNK or len(doc_ids) >= CHUNK // 8:
                yield flush()
                made, doc_ids = made + 1, []
    if doc_ids:
        yield flush()


ENCODED = (
    "chunk long, doc_ids array<long>, held array<boolean>, ends binary, codes binary, words array<string>, "
    "counts array<long>, n_train long"
)


@dataclass
class Vocabulary:
    """Corpus totals and the units.

    ``units`` has the frequent words and the endings; ``starts`` the unit of the first of the ``rare``
    words that a task numbered, by task.
    """

    tokens: int
    types: int
    end: int
    units: dict[str, int]
    starts: np.ndarray
    rare: int

    @property
    def head(self) -> int:
        """Units before the rare words."""
        return len(self.units) + 2


NUMBERED = "chunk long, local int, c long, unit string, first boolean, number long"


def _numbered(least: float):
    """Rows sorted by word, with a number for each rare word: the task and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            c, first = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("c", "first"))
            rare = (c > 0) & (c < least)
            place = made + np.cumsum(rare & first)
            made = int(place[-1]) if len(place) else made
            number = pa.array(np.where(rare, task + place - 1, -1))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("chunk", "local", "c", "unit", "first")), number], ["chunk", "local", "c", "unit", "first", "number"])

    return run


def word_totals(chunks: DataFrame, share: float) -> tuple[DataFrame, int]:
    """Per chunk and word: chunk, local, c, unit, first, number; and the number of training tokens.

    Every word is summed over all chunks by a shuffle on the word, where it has a row per
    chunk at most. ``unit`` is the frequent word itself or, after "~", the ending of any other.
    ``first`` marks one row of each word. ``number`` tells rare training words apart; others have -1.
    """
    tokens = chunks.agg(F.coalesce(F.sum("n_train"), F.lit(0))).first()[0]
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w"))
    rows = rows.select("chunk", "local", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    per_word = Window.partitionBy("word")
    rows = rows.withColumn("c", F.sum("n").over(per_word)).withColumn("first", F.row_number().over(per_word.orderBy("chunk")) == 1)
    unit = F.when((F.col("c") > 0) & (F.col("c") >= share * tokens), F.concat(F.lit("="), "word")).otherwise(
        F.concat(F.lit("~"), F.expr(f"right(word, {ENDING})"))
    )
    rows = rows.select("chunk", "local", "c", unit.alias("unit"), "first")
    return stored(rows.mapInArrow(_numbered(share * tokens), NUMBERED), "word-totals"), tokens


def vocabulary(totals: DataFrame, tokens: int, trained: int, share: float) -> Vocabulary:
    """Collects at most 1 / share words, 1 / share endings and a count per task."""
    seen = totals.where(F.col("first") & (F.col("c") > 0))
    words = seen.where("number < 0").select("unit", F.col("c").alias("n"))
    endings = seen.where("number >= 0").groupBy("unit").agg(F.sum("c").alias("n")).where(F.col("n") >= share * tokens)
    kept = [r["unit"] for part in (words, endings) for r in part.orderBy(F.desc("n"), "unit").collect()]
    units = {u: i for i, u in enumerate(kept, 2)}
    per_task = {r["task"]: (r["n"], r["rare"]) for r in seen.groupBy(F.expr("shiftright(number, 33)").alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("number") >= 0).alias("rare")).collect()}
    rare = np.zeros(max([-1, *per_task]) + 2, np.int64)
    for task, (_, n) in per_task.items():
        rare[task + 1] += n
    types = sum(n for n, _ in per_task.values()) + (trained > 0)
    return Vocabulary(tokens, types, trained, units, len(units) + 2 + np.cumsum(rare), int(rare.sum()))


SEQUENCES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, tail_log double, seq binary"
)


def _units(numbers: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Units of rare words by their numbers."""
    return vocab.starts[numbers >> 33] + (numbers & (1 << 33) - 1)


def sequences(chunks: DataFrame, totals: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per document: its units as 32-bit numbers, and sums over its words."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_log", pa.float64()), ("tail_log", pa.float64()), ("seq", pa.binary())])
    if vocab.head + vocab.rare >= 1 << 31:
        raise ValueError("more words than 32 bits can number")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        n = np.zeros(right.num_rows, np.int64)
        local = right.column("local").to_numpy()
        n[local] = right.column("c").to_numpy()
        number = right.column("number").to_numpy()
        unit, rare = np.full(right.num_rows, REST, np.int64), number >= 0
        unit[local[rare]] = _units(number[rare], vocab)
        unit[local[~rare]] = [vocab.units.get(u, REST) for u in right.column("unit").filter(pa.array(~rare)).to_pylist()]
        log = np.log10(n + 1.0)
        # A rare word's share of its class is told by its count, but for the total of the class.
        rest = np.where(unit >= vocab.head, np.log10(n + SMOOTH), 0.0)
        end_log, end_known = np.log10(vocab.end + 1.0), int(vocab.end > 0)
        for r in left.to_pylist():
            codes, ends = np.frombuffer(r["codes"], np.int32), np.frombuffer(r["ends"], np.int64)

            def total(values: np.ndarray) -> np.ndarray:
                return np.diff(np.r_[0, np.cumsum(values[codes])][np.r_[0, ends]]) if len(codes) else np.zeros(len(ends))

            known, base, tail = total((n > 0).astype(np.int64)), total(log), total(rest)
            seq = unit[codes].astype(np.int32)
            starts = np.r_[0, ends[:-1]]
            out.append(pa.table([
                pa.array(r["doc_ids"], pa.int64()), pa.array(r["held"], pa.bool_()), pa.array(ends - starts + 1),
                pa.array(known.astype(np.int64) + end_known), pa.array(base + end_log), pa.array(tail.astype(float)),
                pa.array([seq[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    left = chunks.select("chunk", "doc_ids", "held", "ends", "codes").groupBy("chunk")
    right = totals.select("chunk", "local", "c", "unit", "number").groupBy("chunk")
    return stored(left.cogroup(right).applyInArrow(run, SEQUENCES), "sequences")


def _line(batch: pa.RecordBatch, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The units of some documents, each followed by END, and where each document ends."""
    parts = batch.column("seq").slice(low, high - low).to_pylist()
    x = np.frombuffer(b"".join(p + b"\0\0\0\0" for p in parts), np.int32).astype(np.int64)
    return x, np.cumsum([len(p) // 4 + 1 for p in parts])


def class_counts(seqs: DataFrame, classes: np.ndarray, k: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first ``head`` units, how often each class stands before it and after it (units x 2k),
    and for all units how often one class follows another (k x k).

    Each task adds up its own counts; the sums over tasks are made per block of units.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, pairs = np.zeros((head, 2 * k), np.int64), np.zeros(k * k, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                x, _ = _line(batch, low, min(batch.num_rows, low + 1024))
                c = classes[x].astype(np.int64)
                before, was = np.r_[END, x[:-1]], np.r_[0, c[:-1]]
                pairs += np.bincount(was * k + c, minlength=k * k)
                size, here, there = head * k, x < head, before < head
                sums[:, :k] += np.bincount(x[here] * k + was[here], minlength=size).reshape(head, k)
                sums[:, k:] += np.bincount(before[there] * k + c[there], minlength=size).reshape(head, k)
        out = [(-1, pairs.tobytes()), *((at, sums[at : at + BLOCK].tobytes()) for at in range(0, head, BLOCK))]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.int64(), pa.binary()))], ["block", "sums"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in t.column("sums").to_pylist())
        return pa.table({"block": t.column("block").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    rows = seqs.where(~F.col("held_out")).select("seq").mapInArrow(run, "block long, sums binary")
    got = rows.groupBy("block").applyInArrow(add, "block long, sums binary").collect()
    out, pairs = np.zeros((head, 2 * k), np.int64), np.zeros((k, k), np.int64)
    for r in got:
        part = np.frombuffer(r["sums"], np.int64)
        if r["block"] < 0:
            pairs = part.reshape(k, k)
        else:
            out[r["block"] : r["block"] + len(part) // (2 * k)] = part.reshape(-1, 2 * k)
    return out, pairs


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def class_table(counts: np.ndarray, classes: np.ndarray, k: int) -> np.ndarray:
    """How often class d follows class c."""
    out = np.zeros((k, k), np.int64)
    np.add.at(out, classes, counts[:, k:])
    return out


def likelihood(pairs: np.ndarray) -> float:
    return float(_f(pairs).sum() - _f(pairs.sum(0)).sum() - _f(pairs.sum(1)).sum())


def _moves(units: np.ndarray, turn: int) -> np.ndarray:
    """Units of one parity move in a pass, so that neighbours' classes mostly hold still."""
    return (units * 2654435761 >> 7 & 1) == turn & 1


def exchange(counts: np.ndarray, classes: np.ndarray, k: int, turn: int, pairs: np.ndarray | None = None) -> np.ndarray:
    """Move every other unit to the class that raises the likelihood most.

    ``pairs`` tells how often each class follows another if there are more units than these. END
    stays alone in class 0.
    """
    pairs = (class_table(counts, classes, k) if pairs is None else pairs).astype(float)
    classes, sums = classes.copy(), pairs.sum(1)
    size = counts[:, k:].sum(1).astype(float)
    for u in np.flatnonzero(_moves(np.arange(len(classes)), turn) & (size > 0)):
        if u < REST:
            continue
        a, left, right = classes[u], counts[u, :k].astype(float), counts[u, k:].astype(float)
        pairs[a] -= right
        pairs[:, a] -= left
        np.maximum(pairs, 0, out=pairs)
        sums[a] -= size[u]
        gain = (_f(pairs + right) - _f(pairs)).sum(1) + (_f(pairs + left[:, None]) - _f(pairs)).sum(0)
        gain -= 2 * (_f(sums + size[u]) - _f(sums))
        gain[0] = -np.inf
        b = int(np.argmax(gain))
        classes[u] = b
        pairs[b] += right
        pairs[:, b] += left
        sums[b] += size[u]
    return classes


OCCURRENCES = "block long, units binary, left binary, right binary"


def occurrences(seqs: DataFrame, head: int) -> DataFrame:
    """Per block of rare units, all their training tokens: which unit, and the units before and after."""
    names = [n.split()[0] for n in OCCURRENCES.split(", ")]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            unit, left, right = (np.concatenate(v) for v in zip(*held))
            block = unit // RARE_BLOCK
            order = np.argsort(block, kind="stable")
            found, starts = np.unique(block[order], return_index=True)
            parts = (np.split(v[order], starts[1:]) for v in ((unit % RARE_BLOCK).astype(np.uint16), left, right))
            out = [found, *([p.tobytes() for p in v] for v in parts)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names)

        held, n = [], 0
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                x, _ = _line(batch, low, min(batch.num_rows, low + 1024))
                at = np.flatnonzero(x >= head)
                held.append((x[at] - head, np.r_[END, x][at].astype(np.int32), x[at + 1].astype(np.int32)))
                n += len(at)
                if n >= CHUNK:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def join(t: pa.Table) -> pa.Table:
        whole = [pa.array([b"".join(t.column(n).to_pylist())], pa.binary()) for n in names[1:]]
        return pa.table([t.column("block").combine_chunks().slice(0, 1), *whole], names)

    rows = seqs.where(~F.col("held_out")).select("seq").mapInArrow(run, OCCURRENCES)
    return stored(rows.groupBy("block").applyInArrow(join, OCCURRENCES), "occurrences")


def _gains(counts: np.ndarray, own: np.ndarray, pairs: np.ndarray, known: np.ndarray) -> np.ndarray:
    """What each class would add to the likelihood as the class of some units (units x k).

    ``counts`` (units x 2k) are as in ``exchange``, ``own`` the units' classes. What a unit counts in its
    own class is taken off there. ``known`` has the gains of all classes by (side, neighbour's class,
    count up to FEW).
    """
    k = len(pairs)
    u, at = np.nonzero(counts)
    n = counts[u, at].astype(float)
    sides = np.stack([pairs.T, pairs])  # by side and neighbour's class below: the pairs with each class
    far = np.flatnonzero(n > FEW)
    told = known[at, np.minimum(n, FEW).astype(np.int64)]
    if len(far):
        with_class = np.concatenate([pairs, pairs.T])[at[far]]
        told[far] = _f(with_class + n[far, None]) - _f(with_class)
    out = np.zeros((len(counts), k))
    starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, np.int64)
    if len(u):
        out[u[starts]] = np.add.reduceat(told, starts)
    here = sides[at // k, own[u], at % k]
    stays = np.bincount(u, _f(here) - _f(here - n), len(counts))
    size, sums = counts[:, k:].sum(1).astype(float), pairs.sum(1)
    out -= 2 * (_f(sums + size[:, None]) - _f(sums))
    out[np.arange(len(own)), own] = stays - 2 * (_f(sums[own]) - _f(sums[own] - size))
    return out


def exchange_rare(rare: DataFrame, classes: np.ndarray, k: int, turn: int, pairs: np.ndarray, head: int) -> np.ndarray:
    """``classes`` with every other rare unit in the class that raises the likelihood most, the others as they are.

    The units of a pass move side by side, each as if it were the only one.
    """
    pairs = pairs.astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_class = np.concatenate([pairs, pairs.T])[:, None, :]
        known = _f(with_class + np.arange(FEW + 1)[:, None]) - _f(with_class)
        for batch in batches:
            for i in range(batch.num_rows):
                low = batch.column("block")[i].as_py() * RARE_BLOCK
                unit, left, right = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("units", np.uint16), ("left", np.int32), ("right", np.int32)))
                own = classes[head + low : head + low + RARE_BLOCK].astype(np.int64)
                base, size = unit.astype(np.int64) * (2 * k), len(own) * 2 * k
                counts = np.bincount(base + classes[left], minlength=size) + np.bincount(base + k + classes[right], minlength=size)
                counts = counts.reshape(-1, 2 * k)
                moving = np.flatnonzero(_moves(head + low + np.arange(len(own)), turn))
                for at in range(0, len(moving), RARE_AT_ONCE):
                    some = moving[at : at + RARE_AT_ONCE]
                    gain = _gains(counts[some], own[some], pairs, known)
                    gain[:, 0] = -np.inf
                    own[some] = gain.argmax(1)
                yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([own.astype(classes.dtype).tobytes()], pa.binary())], ["low", "classes"])

    out = classes.copy()
    for r in rare.mapInArrow(run, "low long, classes binary").collect():
        part = np.frombuffer(r["classes"], classes.dtype)
        out[head + r["low"] : head + r["low"] + len(part)] = part
    return out


@dataclass
class Model:
    """log10 of class transitions, and of units given their classes.

    ``classes`` and ``emit`` are those of the units before the rare words, ``rare`` the classes of
    these; ``scale`` is what log10(count + SMOOTH) of a rare word lacks, by class.
    """

    classes: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    rare: np.ndarray
    scale: np.ndarray


def ending_classes(totals: DataFrame, vocab: Vocabulary, classes: np.ndarray) -> dict[int, int]:
    """By unit of unseen words, the class of most tokens of the rare words with its ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = pa.array([vocab.units.get(u, REST) for u in batch.column("unit").to_pylist()], pa.int64())
            own = classes[_units(batch.column("number").to_numpy(), vocab)].astype(np.int64)
            yield pa.RecordBatch.from_arrays([unit, pa.array(own), batch.column("c")], ["unit", "class", "c"])

    rows = totals.where("first AND number >= 0").select("unit", "number", "c").mapInArrow(run, "unit long, class long, c long")
    per_class = rows.groupBy("unit", "class").agg(F.sum("c").alias("n"))
    top = per_class.groupBy("unit").agg(F.expr("max_by(class, struct(n, -class)) AS class"))
    return {r["unit"]: r["class"] for r in top.collect()}


def cluster(seqs: DataFrame, vocab: Vocabulary, k: int = CLASSES, passes: int = PASSES, totals: DataFrame | None = None) -> Model:
    """Exchange passes from a round-robin start; the most likely assignment is kept.

    ``totals`` tells the classes of unseen words.
    """
    head = vocab.head
    classes = (1 + np.arange(head + vocab.rare) % (k - 1)).astype(np.min_scalar_type(k - 1))
    classes[END] = 0
    rare = occurrences(seqs, head) if vocab.rare and passes else None
    best = None
    for turn in range(passes + 1):
        counts, pairs = class_counts(seqs, classes, k, head)
        if best is None or likelihood(pairs) > best[0]:
            best = likelihood(pairs), classes, pairs, counts[:, :k].sum(1)
        if turn < passes:
            moved = exchange(counts, classes[:head], k, turn, pairs)
            classes = classes.copy() if rare is None else exchange_rare(rare, classes, k, turn, pairs, head)
            classes[:head] = moved
    _, classes, pairs, size = best
    if totals is not None and vocab.rare:
        for unit, c in ending_classes(totals, vocab, classes).items():
            classes[unit] = c
    step = np.log10(pairs + SMOOTH) - np.log10(pairs.sum(1, keepdims=True) + SMOOTH * k)
    scale = -np.log10(np.maximum(pairs.sum(0) + SMOOTH * np.bincount(classes, minlength=k), SMOOTH))
    emit = np.log10(size + SMOOTH) + scale[classes[:head]]
    return Model(classes[:head], step, emit, classes[head:], scale)


def score(docs: DataFrame, share: float = SHARE, k: int = CLASSES, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document.

    The model learns from every document whose crc32(doc_id) mod 7 is not 2 and scores
    all. A null or empty text is the end token alone. A null id hashes as "". Repeated rows
    are documents of their own. Without training documents all counts are 0 and every
    unit is as likely as any other. An empty table gives an empty result. Other columns are
    not looked at.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold == HELD_OUT).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chunks = stored(rows.mapInArrow(encode, ENCODED), "chunks")
    totals, tokens = word_totals(chunks, share)
    trained = chunks.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    vocab = vocabulary(totals, tokens, trained, share)
    seqs = sequences(chunks, totals, vocab)
    model = cluster(seqs, vocab, k, passes, totals)
    classes = np.concatenate([model.classes, model.rare])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                x, ends = _line(part, 0, part.num_rows)
                c = classes[x].astype(np.int64)
                logs = model.step[np.r_[END, c[:-1]], c]
                logs += np.where(x < vocab.head, model.emit[np.minimum(x, vocab.head - 1)], model.scale[c])
                total = np.add.reduceat(logs, np.r_[0, ends[:-1]])
                n = part.column("n_tokens").to_numpy()
                base = part.column("base_log").to_numpy() - n * np.log10(vocab.tokens + vocab.types + 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), part.column("n_tokens"), part.column("n_known"),
                     pa.array(base), pa.array(total + part.column("tail_log").to_numpy())],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return seqs.mapInArrow(run, out).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op1_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents", "doc_id", "text"))
