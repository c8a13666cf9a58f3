"""Toxicity: a support vector machine over gapped subsequences with Nyström landmarks.

The kernel of two words counts their common subsequences of 3 and 4 characters inside 6
neighbouring ones, each gap halving the weight, so an insult keeps most of its similarity
when characters are put in or left out. Words that labelled sentences tie to the toxic
label, whatever their neighbours, are the positive examples. A text scores by its worst word.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.llm.base import stored, table

#: Kernel: subsequence lengths, characters they may span, weight of a skipped character.
ORDERS, SPAN, DECAY = (3, 4), 6, 0.5
_POWERS = DECAY ** np.arange(8)
#: Character classes, table of feature weights, and marks for start, end and padding.
SIGMA, TABLE = 64, 1 << 20
START, END, PAD = 0, 61, 63
#: Labelled rows sampled per label; words of either kind to fit on; landmarks of either kind
#: to begin with.
SAMPLE, POSITIVES, NEGATIVES, LANDMARKS = 10_000, 2_000, 6_000, 160
#: More positive words become landmarks until none has more of its squared length outside.
REST = 0.5
#: Words whose lengths are taken at a time; words whose scores a task keeps.
NORMED, KEPT = 4_096, 400_000
#: Longer words are read in pieces that overlap by SPAN characters.
PIECE = 64
FOLDS, HELD_OUT = 5, 0
#: Share of a telling word's contexts that lie in toxic texts.
PURITY = 0.9

#: Characters written for letters.
LEET = dict(zip("0134578@$!", "oieastbasi"))
SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
EDGES = ".,;:!?\"'()[]{}<>«»“”„…-–—*_~"


def _code(c: str) -> int:
    c = LEET.get(c, c)
    if "a" <= c <= "z":
        return 1 + ord(c) - 97
    return 27 + ord(c) % 20 if c.isalpha() else 47 + ord(c) % 14


class _Codes(dict):
    def __missing__(self, c: str) -> int:
        self[c] = value = _code(c)
        return value


_CODES = _Codes()
_STEPS = [(0, *rest) for p in ORDERS for rest in combinations(range(1, SPAN), p - 1)]


def fold(word: str) -> str:
    return word.lower().strip(EDGES)


def units(text: str | None) -> list[str]:
    """Words, and runs of three or more single characters joined to a word."""
    words = (text or "").split()
    if words:
        words += ["".join(m.split()) for m in SPACED.findall(text)]
    return words


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each kind of subsequence: the word it is in, its table slot, its weight."""
    codes, owner = [], []
    pad = [PAD] * (SPAN - 1)
    for i, w in enumerate(words):
        mine = [START, *map(_CODES.__getitem__, w), END, *pad]
        codes += mine
        owner += [i] * len(mine)
    x, who = np.asarray(codes, np.int64), np.asarray(owner, np.int64)
    n = len(x) - SPAN + 1
    if n <= 0:
        return
    for steps in _STEPS:
        last = x[steps[-1] : n + steps[-1]]
        ok = (x[:n] != PAD) & (last != PAD)
        key = np.zeros(n, np.int64)
        for s in steps:
            key = key * SIGMA + x[s : n + s]
        key = (key[ok] * 2 + (len(steps) == 4)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield who[:n][ok], (key >> np.uint64(44)).astype(np.int64), DECAY ** (steps[-1] + 1 - len(steps))


def lengths(found: list[tuple[np.ndarray, np.ndarray, float]], count: int) -> np.ndarray:
    """Length of the vector of each of ``count`` words from its ``features``: a subsequence that occurs
    several times is one entry, with the sum of its weights."""
    out = np.zeros(count)
    if found:
        # Only the number of skipped characters is kept beside the entry.
        key = np.sort(np.concatenate([((who << 20 | slot) << 3) | round(np.log(weight) / np.log(DECAY)) for who, slot, weight in found]))
        first = np.flatnonzero(np.r_[True, key[1:] >> 3 != key[:-1] >> 3])
        if len(first):
            out += np.bincount(key[first] >> 23, np.add.reduceat(_POWERS[key & 7], first) ** 2, count)
    return np.sqrt(np.maximum(out, 1e-12))


def norms(words: list[str]) -> np.ndarray:
    parts = [words[i : i + NORMED] for i in range(0, len(words), NORMED)]
    return np.concatenate([lengths(list(features(p)), len(p)) for p in parts]) if parts else np.zeros(0)


def word_scores(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's decision for each word; long words by their worst piece."""
    pieces, owner = [], []
    for i, w in enumerate(words):
        w = fold(w)
        for at in range(0, max(1, len(w) - SPAN), PIECE - SPAN):
            pieces.append(w[at : at + PIECE])
            owner.append(i)
    decided = []
    for i in range(0, len(pieces), NORMED):
        count = len(pieces[i : i + NORMED])
        found = list(features(pieces[i : i + NORMED]))
        total = np.zeros(count)
        for who, slot, weight in found:
            total += np.bincount(who, weights[slot], count) * weight
        decided.append(total / lengths(found, count) + bias)
    out = np.full(len(words), -np.inf)
    if decided:
        np.maximum.at(out, np.asarray(owner, np.int64), np.concatenate(decided))
    return out


def _kernel(words: list[str], marks: list[str]) -> np.ndarray:
    """Normalised kernel of words (rows) and landmarks, over the landmarks' subsequences."""
    if len(marks) > 2 * LANDMARKS:  # A block of landmarks needs their own subsequences only.
        return np.hstack([_kernel(words, marks[i : i + 2 * LANDMARKS]) for i in range(0, len(marks), 2 * LANDMARKS)])
    slots = np.unique(np.concatenate([slot for _, slot, _ in features(marks)]))

    def dense(part: list[str]) -> np.ndarray:
        out = np.zeros((len(part), len(slots)), np.float32)
        for who, slot, weight in features(part):
            at = np.searchsorted(slots, slot)
            hit = (at < len(slots)) & (slots[np.minimum(at, len(slots) - 1)] == slot)
            np.add.at(out, (who[hit], at[hit]), weight)
        return out / norms(part)[:, None].astype(np.float32)

    z = dense(marks)
    return np.concatenate([dense(words[i : i + 256]) @ z.T for i in range(0, len(words), 256)]).astype(np.float64)


def covering(words: list[str], first: int, rest: float = REST) -> list[str]:
    """The ``first`` words, and by pivoted Cholesky as many others as it takes until the
    landmarks leave no word more than ``rest`` of its squared length."""
    if len(words) <= first:
        return words
    kernel = _kernel(words, words)
    left, rows, chosen = np.ones(len(words)), np.zeros((len(words), len(words))), []
    while len(chosen) < len(words):
        i = len(chosen) if len(chosen) < first else int(np.argmax(left))
        if len(chosen) >= first and left[i] <= rest:
            break
        n = len(chosen)
        if left[i] > 1e-6:
            rows[n] = (kernel[i] - rows[:n, i] @ rows[:n]) / np.sqrt(left[i])
            left = left - rows[n] ** 2
        left[i] = 0.0
        chosen.append(i)
    return [words[i] for i in chosen]


def fit_machine(positive: list[str], negative: list[str], landmarks: int = LANDMARKS, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Squared-hinge machine on Nyström features, folded into a weight per table slot."""
    marks = covering(positive, landmarks) + negative[:landmarks]
    base = _kernel(marks, marks)
    values, vectors = np.linalg.eigh((base + base.T) / 2)
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    x = np.hstack([_kernel(positive + negative, marks) @ whiten, np.ones((len(positive) + len(negative), 1))])
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    c = np.where(y > 0, 0.5 / len(positive), 0.5 / len(negative)) * len(y)
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        live = y * (x @ w) < 1
        a = x[live] * c[live, None]
        new = np.linalg.solve(penalty + a.T @ x[live], a.T @ y[live])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    beta = whiten @ w[:-1]
    weights = np.zeros(TABLE)
    scale = beta / norms(marks)
    for who, slot, weight in features(marks):
        np.add.at(weights, slot, scale[who] * weight)
    return weights.astype(np.float32), float(w[-1])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with a hash of its neighbours and the label of its text."""
    schema = pa.schema([("unit", pa.string()), ("context", pa.int64()), ("toxic", pa.int32())])
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part, rows = batch.slice(low, 512), set()
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = [fold(w) for w in units(text)]
                for before, w, after in zip(["", *words], words, [*words[1:], ""]):
                    if 0 < len(w) <= PIECE:
                        rows.add((w, zlib.crc32(f"{before} {after}".encode()), toxic))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)] if rows else [[], [], []], schema=schema)


def _worst(weights: np.ndarray, bias: float, a: float, b: float, keep: list[str]):
    """Map batches to the kept columns, the worst word's decision, and a probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A word's score does not depend on its text: words seen before in the task are looked up.
        ids: dict[str, int] = {}
        score = np.zeros(0)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                if len(ids) > KEPT:
                    ids, score = {}, np.zeros(0)
                words, ends = [], []
                for text in part.column("text").to_pylist():
                    words += [ids.setdefault(w, len(ids)) for w in units(text)]
                    ends.append(len(words))
                found = np.full(part.num_rows, -2.0)
                new = list(itertools.islice(ids, len(score), None))
                if new:
                    score = np.concatenate([score, *(word_scores(new[i : i + 20_000], weights, bias) for i in range(0, len(new), 20_000))])
                if words:
                    per = score[np.asarray(words)]
                    starts = np.array([0, *ends[:-1]], np.int64)
                    some = np.asarray(ends) > starts
                    found[some] = np.maximum.reduceat(per, starts[some])
                found = np.clip(found, -2.0, 2.0)
                prob = 1 / (1 + np.exp(-(a * found + b)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keep], pa.array(found), pa.array(prob)], [*keep, "margin", "score"]
                )

    return run


def fold_of(key: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, float, float]:
    """Weights and bias of the machine, and the line from its decision to a log-odds.

    Learns from labelled rows outside the held-out fold, at most ``sample`` of each label, in
    the order of a hash of their ids. Word counts are summed in Spark; the driver receives
    at most POSITIVES and NEGATIVES words and the sample's margins.
    """
    spark = docs.sparkSession
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(fold_of("_id") != HELD_OUT)
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("_id"), "_id"]
    some = [known.where(F.col("toxic") == v).orderBy(*order).limit(sample) for v in (1, 0)]
    # At most 2 * sample ids.
    chosen = F.broadcast(some[0].unionByName(some[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Of rows that repeat a sampled id the smallest text is learnt from: one row per id.
    drawn = texts.join(chosen, texts["doc_id"] == chosen["_id"]).groupBy("_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = stored(drawn.select("text", "toxic"), "toxic-sample")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    nothing = np.zeros(TABLE, np.float32), 0.0, 0.0, float(np.log(prior / (1 - prior)))
    if not n_pos or not n_neg:
        return nothing
    spread = rows.repartition(max(2, spark.sparkContext.defaultParallelism))
    # A word counts once per pair of neighbours: copies of a text add nothing.
    seen = spread.mapInArrow(_contexts, "unit string, context long, toxic int")
    seen = seen.groupBy("unit", "context").agg(F.min("toxic").alias("toxic"))
    seen = seen.groupBy("unit").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    words = stored(seen, "toxic-words")
    total = words.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.count(F.lit(1)).alias("v")).first()
    if not total["p"] or not total["n"]:
        return nothing
    rate, n = total["p"] / (total["p"] + total["n"]), F.col("pos") + F.col("neg")

    def part(k, expected):
        return F.when(k > 0, k * F.log(k / (n * expected))).otherwise(0.0)

    # Likelihood ratio against "a label like any other", at a level that allows for as many
    # tries as there are words; of words, and of what words of more characters begin with.
    level = 2 * float(np.log(max(2, total["v"]))) + 6
    ratio = 2 * (part(F.col("pos"), rate) + part(F.col("neg"), 1 - rate))
    telling = (ratio >= level) & (F.col("pos") / n >= PURITY)
    heads = [
        words.where(F.length("unit") > k + 1)
        .groupBy(F.substring("unit", 1, k).alias("head"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(telling)
        .select("head", ratio.alias("g"))
        for k in (4, 5)
    ]
    signs = words.where(telling).select("unit", ratio.alias("g"))
    for k, head in zip((4, 5), heads):
        signs = signs.unionByName(
            words.where(F.length("unit") > k + 1).join(head, F.substring("unit", 1, k) == F.col("head")).select("unit", "g")
        )
    bad = stored(signs.groupBy("unit").agg(F.max("g").alias("g")).join(words, "unit").where(F.col("pos") / n >= PURITY), "toxic-signs")
    positive = [r["unit"] for r in bad.orderBy(F.desc("g"), F.desc("pos"), "unit").limit(POSITIVES).collect()]
    if not positive:
        return nothing
    clean = words.join(bad.select("unit"), "unit", "left_anti").where(F.col("neg") > 0)
    common = clean.orderBy(F.desc("neg"), "unit").limit(NEGATIVES // 2).collect()
    other = clean.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES // 2).collect()
    taken = set(positive)
    negative = [w for w in dict.fromkeys(r["unit"] for pair in zip(other, common) for r in pair) if w not in taken]
    if not negative:
        return nothing
    weights, bias = fit_machine(positive, negative)
    margins = spread.mapInArrow(_worst(weights, bias, 0.0, 0.0, ["toxic"]), "toxic int, margin double, score double")
    got = margins.select("toxic", "margin").toPandas()  # at most 2 * sample pairs of numbers
    y, x = got["toxic"].to_numpy(float), np.c_[got["margin"].to_numpy(), np.ones(len(got))]
    share = np.where(y > 0, sizes.get(1, 0) / n_pos, sizes.get(0, 0) / n_neg)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + 1e-3 * w
        w = w - np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
    return weights, bias, float(w[0]), float(w[1])


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float, float, float]) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The whole text is read; a null text is an empty one and scores as a text without any
    known word. A null id belongs to fold crc32("") mod 5. Repeated rows score alike. An
    empty table gives an empty result, and with no labels of one kind every text scores the
    share of toxic labels. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_worst(*model, ["doc_id"]), "doc_id long, margin double, score double")
    return scored.select(
        "doc_id", (fold_of() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, all columns kept; each row by its own text,
    whatever its id."""
    model = train(docs, labels)
    # Names that cannot meet those of the score.
    names = ["text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)]
    rows = docs.toDF(*names)
    schema = StructType([*rows.schema, StructField("margin", DoubleType()), StructField("score", DoubleType())])
    scored = rows.mapInArrow(_worst(*model, names), schema)
    return scored.where("NOT score >= 0.5").select(*names).toDF(*docs.columns)


def op7_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return score_texts(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
