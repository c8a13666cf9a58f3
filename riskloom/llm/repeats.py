"""Substring deduplication: windows of words that occur earlier, found by FM-indexes.

Shards are cut by content. Each window of words belongs to the smallest hash of the short
word runs inside it (its anchor), so equal windows have equal anchors, and consecutive
windows mostly share theirs. Stretches of windows whose anchor occurs in other texts, or
again in the same one, go to the anchor's shard. There they are indexed, and streamed
through the index by backward search. What occurs nowhere else is never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table
from riskloom.llm.fmindex import FMIndex
from riskloom.llm.groups import sorted_groups
from riskloom.llm.jaccard import PRIME, WordHashes, mixed

#: Words of a window and of an anchor.
WIDTH, ANCHOR = 20, 5
#: Tokens of a chunk; words of an index; words of a stretch (longer ones are cut).
CHUNK, SHARD, STRETCH = 1_500_000, 400_000, 64
#: Words below one anchor from which its windows are keyed one by one instead.
HOT = 100_000
MANY = -(1 << 63)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to chunks: chunk, ids, compressed texts and their lengths."""
    task, made = TaskContext.get().partitionId() << 24, 0
    engine = zstandard.ZstdCompressor(level=3)
    ids, texts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([task + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int64())),
             pa.array([engine.compress(b"".join(texts))], pa.binary())],
            ["chunk", "ids", "sizes", "texts"],
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
            ids.append(doc_id)
            texts.append(text.as_py())
            held += len(texts[-1]) // 6 + 8
            if held >= CHUNK:
                yield flush()
                ids, texts, held, made = [], [], 0, made + 1
    if ids:
        yield flush()


PACKED = "chunk long, ids array<long>, sizes array<long>, texts binary"


class Chunk:
    """The words of a chunk's documents, and the anchors of their windows."""

    def __init__(self, row: dict, width: int):
        raw = zstandard.ZstdDecompressor().decompress(row["texts"])
        ends = np.cumsum(row["sizes"])
        self.number, self.ids, self.width = row["chunk"], row["ids"], width
        self.words = [raw[e - s : e].split() for s, e in zip(row["sizes"], ends)]
        self.digests = [hashlib.md5(raw[e - s : e]).digest() for s, e in zip(row["sizes"], ends)]

    def rows(self) -> list[int]:
        """The first document of each text: smallest id, then place."""
        first: dict[bytes, tuple] = {}
        for i, (digest, doc_id) in enumerate(zip(self.digests, self.ids)):
            key = (doc_id is None, doc_id, i) if doc_id is not None else (True, 0, i)
            if digest not in first or key < first[digest]:
                first[digest] = key
        return sorted(k[2] for k in first.values())

    def runs(self, rows: list[int]) -> tuple[np.ndarray, ...]:
        """Stretches of windows with one anchor: document, first window, windows, anchor."""
        hashes = WordHashes()
        size = np.array([len(self.words[i]) for i in rows], np.int64)
        doc = np.repeat(np.asarray(rows, np.int64), size)
        h = np.fromiter((hashes[w] for i in rows for w in self.words[i]), np.uint64, int(size.sum()))
        n = len(h) - self.width + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.int64),)
        k = min(ANCHOR, self.width)
        g = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            g = g * PRIME + h[j : j + len(g)]
        least, have, want = mixed(g), 1, self.width - k + 1
        # Word runs that come again within reach of one window: their windows may repeat
        # inside a single stretch, as in "a b a b a b".
        again = [least[:-lag][least[:-lag] == least[lag:]] for lag in range(1, want + 1)]
        self.periodic = np.unique(np.concatenate(again)).view(np.int64)
        while have < want:
            add = min(have, want - have)
            least = np.minimum(least[: len(least) - add], least[add:])
            have += add
        inside = doc[:n] == doc[self.width - 1 :]
        place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
        most = STRETCH - self.width + 1
        new = np.r_[True, (least[1:n] != least[: n - 1]) | (doc[1:n] != doc[: n - 1])] & inside
        start = np.flatnonzero(new)
        if not len(start):
            return (np.zeros(0, np.int64),) * 4
        stop = np.minimum(np.r_[start[1:], n], np.searchsorted(doc, doc[start], side="right") - self.width + 1)
        # Long stretches in pieces.
        pieces = -(-(stop - start) // most)
        rep = np.repeat(np.arange(len(start)), pieces)
        off = (np.arange(len(rep)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * most
        begin = start[rep] + off
        count = np.minimum(stop[rep] - begin, most)
        return doc[begin], place[begin], count, least[begin].view(np.int64)


def _chunks(left: pa.Table, width: int) -> Iterator[Chunk]:
    for r in left.to_pylist():
        yield Chunk(r, width)


def _anchors(width: int):
    """Anchors of a chunk: key, text (a number of the text, or MANY if more than one
    stretch here has it), chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                for c in _chunks(pa.Table.from_batches([batch.slice(row, 1)]), width):
                    doc, _, _, key = c.runs(c.rows())
                    if not len(key):
                        continue
                    names, at, times = np.unique(key, return_index=True, return_counts=True)
                    digest = {i: int.from_bytes(c.digests[i][:8], "little", signed=True) for i in set(doc[at].tolist())}
                    text = np.array([digest[i] for i in doc[at].tolist()], np.int64)
                    text[(times > 1) | np.isin(names, c.periodic)] = MANY
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names), pa.array(text), pa.array(np.full(len(names), c.number))], ["key", "text", "chunk"]
                    )

    return run


STRETCHES = "sid binary, key long, place struct<late:boolean,doc_id:long,row:long,start:long>, words long, seg binary"


def _stretches(width: int):
    """A chunk's stretches whose anchor occurs more than once. Equal stretches of a chunk
    but the first come without ``sid``: they are known to be repeats."""
    place_type = pa.struct([("late", pa.bool_()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64())])
    schema = pa.schema([("sid", pa.binary()), ("key", pa.int64()), ("place", place_type), ("words", pa.int64()), ("seg", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted, out = np.unique(right.column("key").to_numpy()), []
        for c in _chunks(left, width):
            doc, start, n, key = c.runs(c.rows())
            hit = np.isin(key, wanted)
            order = sorted(
                zip(doc[hit].tolist(), start[hit].tolist(), n[hit].tolist(), key[hit].tolist()),
                key=lambda r: (c.ids[r[0]] is None, c.ids[r[0]] or 0, r[0], r[1]),
            )
            seen, rows = set(), []
            for i, s, m, k in order:
                seg = b" ".join(c.words[i][s : s + m + width - 1])
                sid = hashlib.md5(seg).digest()
                place = {"late": c.ids[i] is None, "doc_id": c.ids[i], "row": (c.number << 24) + i, "start": s}
                again = sid in seen
                seen.add(sid)
                rows.append({"sid": None if again else sid, "key": k, "place": place, "words": m + width - 1, "seg": None if again else seg})
            out.append(pa.Table.from_pylist(rows, schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def first_and_later(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first place of each stretch, and the places of all its repeats (row, start, words)."""
    firsts = rows.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("place").alias("place"), F.first("key").alias("key"), F.first("words").alias("words"), F.first("seg").alias("seg")
    )
    firsts = stored(firsts, "first-stretches")
    marks = firsts.select(F.col("sid").alias("_sid"), F.col("place").alias("_place"))
    own = rows.where("sid IS NOT NULL").select("sid", "place", "words")
    later = own.join(marks, own["sid"] == marks["_sid"]).where(~F.col("place").eqNullSafe(F.col("_place")))
    known = rows.where("sid IS NULL").select("place", "words")
    later = later.select("place", "words").unionByName(known)
    return firsts, later.select(F.col("place.row").alias("row"), F.col("place.start").alias("start"), "words")


def _search(width: int):
    """Groups of anchors to indexes of about SHARD words; windows that occur earlier."""

    def index(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = pa.concat_tables(held)
        rows = sorted(
            zip(t.column("place").to_pylist(), t.column("seg").to_pylist()),
            key=lambda r: (r[0]["late"], r[0]["doc_id"] or 0, r[0]["row"], r[0]["start"]),
        )
        names: dict[bytes, int] = {}
        texts = [np.array([names.setdefault(w, len(names) + 1) for w in seg.split()], np.int64) for _, seg in rows]
        fm = FMIndex(texts, width)
        size = np.array([len(x) for x in texts], np.int64)
        out = [[], [], []]
        for (place, _), hit in zip(rows, fm.earlier(texts, np.cumsum(size + 1) - size - 1)):
            if hit.any():
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False]))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    out[0].append(place["row"])
                    out[1].append(place["start"] + a)
                    out[2].append(b - a + width - 1)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["row", "start", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in sorted_groups(batches, ["key"]):
            if t.num_rows < 2 and t.column("words")[0].as_py() == width:
                continue  # one window alone
            held.append(t)
            size += int(np.sum(t.column("words").to_numpy()))
            if size >= SHARD:
                yield from index(held)
                held, size = [], 0
        if held:
            yield from index(held)

    return run


def _windows(width: int):
    """Stretches to windows, each under a key of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(low, 256).to_pylist():
                    words = r["seg"].split()
                    for a in range(len(words) - width + 1):
                        sid = hashlib.md5(b" ".join(words[a : a + width])).digest()
                        place = r["place"] | {"start": r["place"]["start"] + a}
                        rows.append({"sid": sid, "key": r["key"], "place": place, "words": width, "seg": b""})
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return run


RESULT = "doc_id long, row long, digest binary, n_words long, n_removed long, kept_sha256 string, kept binary"


def _cut(width: int, texts: bool):
    """Documents without the words of the given stretches."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        gone: dict[int, list[tuple[int, int]]] = {}
        for row, start, n in zip(*(right.column(c).to_pylist() for c in ("row", "start", "words"))):
            gone.setdefault(row & 0xFFFFFF, []).append((start, n))
        out = []
        for c in _chunks(left, width):
            rows = []
            for i, words in enumerate(c.words):
                n, kept = len(words), words
                if i in gone:
                    keep = np.ones(n, bool)
                    for start, m in gone[i]:
                        keep[start : start + m] = False
                    kept = [words[j] for j in np.flatnonzero(keep)]
                joined = b" ".join(kept)
                rows.append((c.ids[i], (c.number << 24) + i, c.digests[i], n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined if texts else None))
            out.append(pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def cut_repeats(docs: DataFrame, width: int = WIDTH, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept, if asked for).

    Removed is each word in a window of ``width`` words that also starts earlier: in a
    document with a smaller id, or in the same one before. Windows are those of the input.

    Of equal texts only the first takes part in the search; the others lose all words if
    they have a window at all. An anchor with more than HOT words of different stretches
    has its windows keyed one by one by their own hashes. So no group grows with
    the copies, or the contexts, of a passage.

    A null text has no words. A null id comes after all others. Rows that repeat an id are
    documents of their own, the earlier the one read first, except that rows equal in
    id and text count as one document and are cut alike. An empty table gives an empty
    result. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunks = stored(rows.mapInArrow(pack, PACKED), "packed")
    keys = chunks.mapInArrow(_anchors(width), "key long, text long, chunk long")
    per_key = Window.partitionBy("key")
    shared = keys.withColumn("_a", F.min("text").over(per_key)).withColumn("_b", F.max("text").over(per_key))
    shared = shared.where((F.col("_a") != F.col("_b")) | (F.col("_a") == MANY)).select("chunk", "key")
    found = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_stretches(width), STRETCHES)
    found = stored(found, "stretches")
    firsts, later = first_and_later(found)

    heavy = firsts.groupBy("key").agg(F.sum("words").alias("_n")).where(F.col("_n") >= HOT).select(F.col("key").alias("_hot"))
    heavy = stored(heavy, "hot-anchors")
    usual = firsts.join(heavy, firsts["key"] == heavy["_hot"], "left_anti").select("key", "place", "words", "seg")
    by_index = usual.repartition("key").sortWithinPartitions("key").mapInArrow(_search(width), "row long, start long, words long")
    single = firsts.join(heavy, firsts["key"] == heavy["_hot"]).select(*[firsts[c] for c in ("sid", "key", "place", "words", "seg")])
    _, by_window = first_and_later(stored(single.mapInArrow(_windows(width), STRETCHES), "windows"))

    gone = later.unionByName(by_index).unionByName(by_window).withColumn("chunk", F.shiftright("row", 24))
    cut = chunks.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(_cut(width, texts), RESULT)
    cut = stored(cut, "cut")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    first = cut.groupBy(F.col("digest").alias("_digest")).agg(F.min(order).alias("_first"))
    first = stored(first, "first-texts")
    same = cut.join(first, cut["digest"] == first["_digest"])
    # A copy of the first document itself shares its fate; another document's copy loses all.
    own = F.col("doc_id").eqNullSafe(F.col("_first.doc_id"))
    twin = cut.select(F.col("row").alias("_row"), F.col("n_removed").alias("_n"), F.col("kept_sha256").alias("_sha"), F.col("kept").alias("_kept"))
    repeated = F.col("row") != F.col("_first.row")
    lost = repeated & ~own & (F.col("n_words") >= width)
    done = same.where(~(repeated & own)).select(
        "doc_id", "n_words",
        F.when(lost, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(lost, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(lost, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
    )
    alike = same.where(repeated & own).select("doc_id", "n_words", F.col("_first.row").alias("_of"))
    alike = alike.join(twin, alike["_of"] == twin["_row"]).select(
        "doc_id", "n_words", F.col("_n").alias("n_removed"), F.col("_sha").alias("kept_sha256"), F.col("_kept").alias("kept")
    )
    out = done.unionByName(alike)
    return out if texts else out.drop("kept")


def op9_fm_index_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = f"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, unnest(range(len(words) - {WIDTH - 1})) AS start, words FROM w WHERE len(words) >= {WIDTH}
), hashed AS (
  SELECT doc_id, start, md5(array_to_string(words[start + 1 : start + {WIDTH}], ' ')) AS h FROM windows
), later AS (
  SELECT doc_id, start FROM (
    SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS r FROM hashed) WHERE r > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places FROM (
    SELECT doc_id, unnest(range(start, start + {WIDTH})) AS p FROM later) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
    CASE WHEN places IS NULL THEN words ELSE
      list_transform(list_sort(list_filter(range(len(words)), lambda i: NOT list_contains(places, i))), lambda i: words[i + 1]) END AS k
  FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""
