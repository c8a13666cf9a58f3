"""Byte-level BPE: each distinct word of the corpus is encoded once, and its ids joined back.

Texts are cut into pre-tokens ("words") by a pattern. A chunk holds the texts of a part of a
task: its distinct words in order, and for each place in its texts the number of the word
there. Only the words leave the chunk, one row for each, however often they occur; so a
word as common as " the" is one row per chunk in the shuffle by word, where it is encoded.
Ids return packed by chunk, and the chunk's places pick them up.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Places of a chunk; bits of a place's number within its chunk.
CHUNK, BITS = 4_000_000, 24
#: Bytes from which merges are taken from a heap instead of by looking at all pairs.
LONG = 48
#: Places whose ids are put together at a time; words whose ids are packed at a time.
BLOCK, HELD = 250_000, 200_000


def read_ranks(path: str) -> bytes:
    """The rank file: lines of a token in base64 and its id. Its size is that of a vocabulary."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


@lru_cache(maxsize=2)
def _tokens(raw: bytes) -> list[bytes | None]:
    """The token-byte table: the bytes of each id."""
    ranks = _ranks(raw)
    out: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the pair of neighbours with the smallest rank is joined, the leftmost
    first, until no pair is in the table. A word that is in the table is one id."""
    if word in ranks:
        return [ranks[word]]
    if len(word) < LONG:
        parts = [word[i : i + 1] for i in range(len(word))]
        scores = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            known = [s for s in scores if s is not None]
            if not known:
                return [ranks[p] for p in parts]
            i = scores.index(min(known))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i > 0:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i])
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1])
    # The same by a heap of pairs; a pair whose ends have changed since is passed over.
    n = len(word)
    stop = list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = after[i]
        rank = ranks.get(word[i : stop[j]]) if j < n else None
        return None if rank is None else (rank, i, stop[j])

    heap = [p for p in map(pair, range(n)) if p]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or stop[j] != end:
            continue
        alive[j], stop[i], after[i] = False, end, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            found = pair(k) if k >= 0 else None
            if found:
                heapq.heappush(heap, found)
    return [ranks[word[i : stop[i]]] for i in range(n) if alive[i]]


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte so that the nearly constant high bytes shrink to nothing."""
    engine = zstandard.ZstdCompressor(level=3).compressobj()
    planes = [engine.compress((values >> (8 * k)).astype(np.uint8).tobytes()) for k in range(4)]
    return b"".join([*planes, engine.flush()])


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(raw), np.uint8).reshape(4, -1)
    out = planes[0].astype(np.uint32)
    for k in range(1, 4):
        if planes[k].any():
            out |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _pack_words(words: list[str]) -> tuple[bytes, bytes]:
    """Lengths in bytes, and the compressed bytes."""
    raw = [w.encode() for w in words]
    return _pack(np.array([len(b) for b in raw], np.int64)), zstandard.ZstdCompressor(level=3).compress(b"".join(raw))


def _unpack_words(lengths: bytes, raw: bytes) -> pa.StringArray:
    ends = np.r_[0, np.cumsum(_unpack(lengths), dtype=np.int64)].astype(np.int32)
    data = zstandard.ZstdDecompressor().decompress(raw)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))


CHUNKS = "chunk long, ids array<long>, sizes binary, places binary, lengths binary, words binary"


def _chunks(pattern: str):
    """Documents to chunks: for each text its number of places, for each place the number of
    its word, and the words by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        task, made = TaskContext.get().partitionId() << 20, 0
        ids: list[int | None] = []
        numbers: dict[str, int] = {}
        cut: dict[bytes, np.ndarray] = {}
        texts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            # Words in alphabetical order: neighbours share their beginnings.
            words = sorted(numbers)
            rank = np.empty(len(words), np.uint32)
            rank[[numbers[w] for w in words]] = np.arange(len(words), dtype=np.uint32)
            packed = [_pack(np.array([len(t) for t in texts])), _pack(rank[np.concatenate(texts)]), *_pack_words(words)]
            return pa.RecordBatch.from_arrays(
                [pa.array([task + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([p], pa.binary()) for p in packed)],
                ["chunk", "ids", "sizes", "places", "lengths", "words"],
            )

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = value.as_py()
                digest = hashlib.sha256(text.encode()).digest()
                if digest not in cut:
                    cut[digest] = np.array([numbers.setdefault(w, len(numbers)) for w in find(text)], np.int32)
                ids.append(doc_id)
                texts.append(cut[digest])
                held += len(cut[digest])
                if held >= CHUNK or len(numbers) >= 1 << (BITS - 1):
                    yield flush()
                    ids, numbers, cut, texts, held, made = [], {}, {}, [], 0, made + 1
        if ids:
            yield flush()

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each word of a chunk: the word, and chunk and number in one."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = batch.column("chunk")[row].as_py()
            words = _unpack_words(batch.column("lengths")[row].as_py(), batch.column("words")[row].as_py())
            if len(words) >= 1 << BITS:
                raise ValueError("a text has too many different words for a place number")
            place = (chunk << BITS) + np.arange(len(words))
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([words[at : at + 50_000], pa.array(place[at : at + 50_000])], ["word", "place"])


def _encoded(raw: bytes):
    """Rows (word, place) sorted by word to rows (chunk, numbers, lengths, ids).

    Each run of one word is encoded once, and its ids joined to every row of the run. HELD rows at a
    time are packed by chunk; a chunk's numbers rise as its words do.
    """

    def pack(places: list[np.ndarray], ids: list[bytes]) -> pa.RecordBatch:
        place = np.concatenate(places)
        order = np.argsort(place >> BITS, kind="stable")
        chunk, number = place[order] >> BITS, place[order] & ((1 << BITS) - 1)
        lengths = np.array([len(b) >> 2 for b in ids])
        cuts = np.r_[0, np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(chunk)]
        out = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            joined = np.frombuffer(b"".join([ids[k] for k in order[lo:hi]]), "<u4")
            out.append((int(chunk[lo]), _pack(np.diff(number[lo:hi], prepend=0)), _pack(lengths[order[lo:hi]]), _pack(joined)))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], ["chunk", "numbers", "lengths", "joined"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(raw)
        last, last_ids = None, b""
        places: list[np.ndarray] = []
        ids: list[bytes] = []
        for batch in batches:
            for word in batch.column("word"):
                text = word.as_py()
                if text != last:
                    last, last_ids = text, np.array(merge(text.encode(), ranks), "<u4").tobytes()
                ids.append(last_ids)
            places.append(batch.column("place").to_numpy())
            if len(ids) >= HELD:
                yield pack(places, ids)
                places, ids = [], []
        if ids:
            yield pack(places, ids)

    return run


PACKED = "chunk long, numbers binary, lengths binary, joined binary"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("text", pa.binary())])


def _text(ids: np.ndarray, tokens: list[bytes | None]) -> bytes:
    """Each id meets its row of the token-byte table."""
    try:
        return b"".join([tokens[i] for i in ids.tolist()])
    except (IndexError, TypeError):
        raise ValueError("an id is not in the token-byte table") from None


def _reassemble(raw: bytes, decode: bool):
    """The texts of a chunk as ids: each place takes the ids of its word's number."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = _tokens(raw) if decode else []
        parts = [
            (np.cumsum(_unpack(n), dtype=np.int64), _unpack(k), _unpack(j))
            for n, k, j in zip(*(right.column(c).to_pylist() for c in ("numbers", "lengths", "joined")))
        ]
        number, length, ids = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        size, start = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        size[number], start[number] = length, np.cumsum(length, dtype=np.int64) - length
        blocks = [RESULT.empty_table()]
        for row in range(left.num_rows):
            doc_ids = left.column("ids")[row].as_py()
            sizes, places = (_unpack(left.column(c)[row].as_py()) for c in ("sizes", "places"))
            ends = np.cumsum(sizes, dtype=np.int64)
            at, done = 0, 0
            while at < len(sizes):
                stop = max(at + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
                here = places[done : ends[stop - 1]]
                many = size[here]
                upto = np.cumsum(many)
                joined = ids[np.repeat(start[here] - upto + many, many) + np.arange(int(many.sum()))]
                bound = np.r_[0, upto][ends[at:stop] - done]
                mine = [joined[lo:hi] for lo, hi in zip(np.r_[0, bound[:-1]], bound)]
                texts = [_text(x, tokens) if decode else None for x in mine]
                columns = (doc_ids[at:stop], [len(x) for x in mine], [x.astype("<u4").tobytes() for x in mine], texts)
                # A batch of its own for each block: neither side holds a chunk's results at once.
                blocks.append(pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(columns, RESULT)], schema=RESULT))
                at, done = stop, int(ends[stop - 1])
        return pa.concat_tables(blocks)

    return run


def encode(docs: DataFrame, ranks: bytes, pattern: str = public_tokenizers.PATTERN, decode: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers).

    With ``decode`` also ``text``, the bytes that the ids decode to, in the task that has them.

    ``ranks`` are the bytes of a rank file. Each match of ``pattern`` is a word, encoded by
    itself, without special tokens: ``merge``. The chunks are dealt once, by their number; the
    words of that deal and the texts that take ids back from it read the same shuffle.

    A null text is empty and has no tokens. Ids may be null or repeat: each row has its own
    result. A text of any length is one row of its chunk. Equal texts of a chunk are cut once. An
    empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunks = rows.mapInArrow(_chunks(pattern), CHUNKS).repartition("chunk")
    # All rows of a word lie side by side in one task: one row per chunk that has it.
    words = chunks.mapInArrow(_words, "word string, place long").repartition("word").sortWithinPartitions("word")
    packed = words.mapInArrow(_encoded(ranks), PACKED)
    both = chunks.groupBy("chunk").cogroup(packed.groupBy("chunk"))
    out = both.applyInArrow(_reassemble(ranks, decode), "doc_id long, n_tokens long, ids binary, text binary")
    return out if decode else out.drop("text")


def decoded(ids: Column, ranks: bytes) -> Column:
    """The bytes behind ids as ``encode`` gives them: each id meets its row of the token-byte
    table, which has a row per token of the vocabulary and is looked up by place. Null ids give null;
    an id without a row is an error."""

    @F.pandas_udf("binary")
    def decode(column: pd.Series) -> pd.Series:
        tokens = _tokens(ranks)
        return column.map(lambda raw: None if raw is None else _text(np.frombuffer(raw, "<u4"), tokens))

    return decode(ids)


def op12_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    tokens = encode(table(spark, sf_dir, "documents", "doc_id", "text"), ranks, decode=True)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
