"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table
from riskloom.llm.groups import components, sorted_groups

#: Words of a shingle, similarity of a link, and the recall aimed at for links just there.
N, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Tries of the forest and their deepest level.
TREES, DEEPEST = 24, 12
#: Texts of a block; larger nodes of a trie are compared block by block.
BLOCK = 512
SEED = 20_240_601
GOLD = np.uint64(0x9E3779B97F4A7C15)
PRIME = np.uint64(1_099_511_628_211)


def depth_for(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, deepest: int = DEEPEST) -> int:
    """The longest prefix that still finds a pair at the threshold with probability ``recall``.

    A pair of similarity s shares a prefix of length d in one trie or more with
    probability 1 - (1 - s^d)^trees; the prefix is shortened until that suffices.
    """
    for d in range(deepest, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    raise ValueError("more trees are needed for this recall")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def shingles(words: list[bytes], hashes: WordHashes, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; a shorter text is one run."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out = np.zeros(max(1, len(h) - n + 1), np.uint64)
    for j in range(min(n, len(h))):
        out = out * PRIME + h[j : j + len(out)]
    return np.unique(mixed(out + np.uint64(min(n, len(h)))))


class Forest:
    """Labels of a set of shingles: one number per trie for the prefix of its signature."""

    def __init__(self, trees: int = TREES, depth: int | None = None, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth or depth_for(trees=trees)
        self.a = rng.integers(1, 1 << 63, trees * self.depth, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, trees * self.depth, np.uint64)

    def labels(self, x: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), 2048):
            part = x[at : at + 2048]
            least = np.minimum(least, ((self.a[:, None] * part) + self.b[:, None]).min(axis=1))
        out = np.arange(self.trees, dtype=np.uint64) + GOLD
        for column in least.reshape(self.trees, self.depth).T:
            out = mixed(out * PRIME + column)
        return out.view(np.int64)


def _signatures(forest: Forest, n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            digests, sizes, keys, known = [], [], [], {}
            for text in batch.column("text").cast(pa.binary()):
                words = words_of(text.as_py())
                digest = hashlib.md5(b" ".join(words)).digest()
                if digest not in known:
                    x = shingles(words, hashes, n)
                    known[digest] = len(x), forest.labels(x) if len(x) else None
                digests.append(digest)
                sizes.append(known[digest][0])
                keys.append(known[digest][1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, schema.types[3])], schema=schema
            )

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    c = column.combine_chunks()
    return np.asarray(c.flatten(), np.int64).reshape(len(c), -1) if len(c) else np.zeros((0, 1), np.int64)


def _open_pairs(t: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of both sides of a group, and which pairs to compare here.

    A pair belongs to the first trie in which it meets, and sizes must allow the
    similarity at all.
    """
    block, lo, hi = t.column("block").to_numpy(), t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
    a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    keys, n, cid = _matrix(t.column("keys")), t.column("n").to_numpy(), t.column("cid").to_numpy()
    tree = int(np.flatnonzero(keys[0] == t.column("key")[0].as_py())[0])
    small, large = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
    todo = small >= threshold * large
    todo &= (cid[a][:, None] < cid[b]) if lo == hi else True
    for k in range(tree):
        todo &= keys[a, k][:, None] != keys[b, k]
    return a, b, todo


GROUP = ["key", "lo", "hi"]
MEMBER = "key long, lo long, hi long, block long, cid long, n long, copies long, keys array<long>"


def _needed(threshold: float):
    """Members of groups that have a pair to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, GROUP):
            if t.num_rows < 2:
                continue
            a, b, todo = _open_pairs(t, threshold)
            rows = np.union1d(a[todo.any(axis=1)], b[todo.any(axis=0)])
            if len(rows):
                yield from t.take(pa.array(rows)).to_batches()

    return run


def common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, todo: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs in ``todo``."""
    out = np.zeros(todo.shape, np.float32)
    pairs = np.argwhere(todo)
    if len(pairs) <= 200:
        for i, j in pairs:
            out[i, j] = len(np.intersect1d(sets[a[i]], sets[b[j]], assume_unique=True))
        return out
    rows = np.union1d(a, b)
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    names, code, times = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[code] > 1
    owner, code = owner[keep], shared[code[keep]]
    place = {r: i for i, r in enumerate(rows)}
    left, right = [place[r] for r in a], [place[r] for r in b]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(shared[-1]) + 1, 4096):
        s, e = np.searchsorted(code, (low, low + 4096))
        m = np.zeros((len(rows), 4096), np.float32)
        m[owner[s:e], code[s:e] - low] = 1
        out += m[left] @ m[right].T
    return out


def _verified(threshold: float):
    """Each linked member's root in its group, and the documents it links to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, GROUP):
            a, b, todo = _open_pairs(t, threshold)
            if not todo.any():
                continue
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            n, copies, cid = (t.column(c).to_numpy() for c in ("n", "copies", "cid"))
            met = common(sets, a, b, todo)
            # |A & B| / |A | B| >= threshold
            link = todo & (met * (1 + threshold) >= threshold * (n[a][:, None] + n[b]) - 1e-3)
            if not link.any():
                continue
            full = np.zeros((t.num_rows, t.num_rows), bool)
            full[np.ix_(a, b)] |= link
            full |= full.T
            links = full @ copies.astype(np.float64)
            some = np.flatnonzero(full.any(axis=1))
            full, root = full[np.ix_(some, some)], cid[some]
            while True:
                least = np.minimum(root, np.where(full, root, np.iinfo(np.int64).max).min(axis=1))
                if (least == root).all():
                    break
                root = least
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[some]), pa.array(root), pa.array(links[some].astype(np.int64))], ["cid", "root", "links"]
            )

    return run


def _shingled(n: int):
    """Sets of the wanted texts: cid, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                cids, sets = [], []
                for text, digest, cid in zip(part.column("text").cast(pa.binary()), part.column("digest"), part.column("cid")):
                    words = words_of(text.as_py())
                    if hashlib.md5(b" ".join(words)).digest() == digest.as_py():
                        cids.append(cid.as_py())
                        sets.append(shingles(words, hashes, n).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sets, pa.binary())], ["cid", "shingles"])

    return run


def near_duplicates(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES) -> DataFrame:
    """One row per document: doc_id, copy_id, class_id, n_links.

    Texts are alike if they share ``threshold`` of their shingles, sets of ``n`` words in
    lower case (a shorter text is one shingle). Texts with equal words are copies:
    ``copy_id`` is the smallest id among them, and only one of them is compared.
    ``class_id`` is the smallest id that a chain of links leads to, ``n_links`` the number of
    other documents linked directly, copies included. Links are exact; the forest misses
    one at the threshold with probability 1 - ``recall`` at most, and copies never.

    The work inside a node of a trie is cut into pairs of blocks, and each pair of texts is
    compared in one trie only. Pairs are never written: a block pair returns sums per
    text and a star of links that keeps its components.

    Null and empty texts link to nothing and are classes of their own (class_id = doc_id).
    A null id is the smallest of its copies only if all are null. Repeated rows are copies.
    An empty table gives an empty result; other columns are not looked at.
    """
    depth = depth_for(threshold, recall, trees)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    signed = rows.mapInArrow(_signatures(Forest(trees, depth), n), "doc_id long, digest binary, n long, keys array<long>")
    signed = stored(signed, "signatures")
    classes = signed.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    entries = classes.select("cid", F.explode("keys").alias("key"))
    nodes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1").withColumnRenamed("key", "_key")
    met = entries.join(nodes, entries["key"] == nodes["_key"]).select("key", "cid", F.ceil(F.col("_size") / BLOCK).alias("_blocks"))
    met = met.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("_blocks")))
    about = classes.select(F.col("cid").alias("_cid"), "n", "copies", "keys")
    met = met.join(about, met["cid"] == about["_cid"]).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    met = met.select("key", F.least("block", "_other").alias("lo"), F.greatest("block", "_other").alias("hi"), "block", "cid", "n", "copies", "keys")
    needed = met.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_needed(threshold), MEMBER)
    needed = stored(needed, "members")

    wanted = needed.select(F.col("cid").alias("_cid")).distinct()
    wanted = classes.join(wanted, classes["cid"] == wanted["_cid"]).select("cid", "rep", "digest")
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["rep"])).select("text", "digest", "cid")
    sets = texts.mapInArrow(_shingled(n), "cid long, shingles binary").groupBy(F.col("cid").alias("_cid")).agg(F.first("shingles").alias("shingles"))
    full = needed.join(sets, needed["cid"] == sets["_cid"]).drop("_cid")
    found = full.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_verified(threshold), "cid long, root long, links long")
    found = stored(found, "links")

    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    named = roots.join(classes.select("cid", "rep"), roots["id"] == F.col("cid")).select("id", "root", "rep")
    least = named.groupBy(F.col("root").alias("_root")).agg(F.min("rep").alias("class_id"))
    per_class = named.join(least, named["root"] == least["_root"]).select(F.col("id").alias("_id"), "class_id")
    links = found.groupBy(F.col("cid").alias("_link")).agg(F.sum("links").alias("links"))
    known = classes.select("digest", "rep", "copies", "cid")
    known = known.join(per_class, known["cid"] == per_class["_id"], "left").join(links, known["cid"] == links["_link"], "left")
    known = stored(known.select(F.col("digest").alias("_digest"), "rep", "copies", "class_id", "links"), "classes")
    all_rows = signed.select("doc_id", "digest")
    out = all_rows.join(known, all_rows["digest"] == known["_digest"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("rep")).alias("copy_id"),
        F.coalesce("class_id", "rep", "doc_id").alias("class_id"),
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )


def one_per_class(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each class, all columns kept.

    Rows without an id cannot be told apart and all stay; of rows that repeat the id
    and text that stays, one stays.
    """
    groups = near_duplicates(docs.select("doc_id", "text")).where("doc_id IS NOT NULL AND doc_id = class_id")
    kept = groups.groupBy(F.col("doc_id").alias("_kept_id")).agg(F.count(F.lit(1)).alias("_kept_rows"))
    kept = stored(kept, "kept")
    stay = docs.join(kept, docs["doc_id"] == kept["_kept_id"], "left").where(F.col("_kept_rows").isNotNull() | F.col("doc_id").isNull())
    once = stay.where("coalesce(_kept_rows, 1) = 1").select(*[docs[c] for c in docs.columns])
    again = stay.where("_kept_rows > 1").select(*[docs[c] for c in docs.columns]).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)


def op3_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
