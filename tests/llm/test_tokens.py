"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskloom.llm import bpe
from tests.conftest import SF
from tests.llm.test_models import frame

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip_of_the_given_documents(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = bpe.op12_byte_level_bpe(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("chunk,block,batch", [(8_000_000, 1_000_000, 10_000), (7, 3, 2)])
def test_edges(spark, library, monkeypatch, chunk, block, batch):
    """Nulls, empty and blank texts, odd white space, one long word, ties of ids, copies."""
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "HELD", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    texts = [
        (1, None), (2, ""), (3, "   "), (4, "a\x1cb\x85c\u2003 d\u3000"), (5, "word" * 3000), (6, "x y" * 2000),
        (7, "\U0001f600 \U0001f468\u200d\U0001f469 é <|endoftext|> it's I'LL"), (7, "again"), (7, "again"), (None, "no id 123 ٤"),
        (8, "\n\n  \tdef f(x):\n    return x  \n"), (9, "日本語のテキスト 한국어"), (10, "ab" * 47 + " " * 90),
    ]
    try:
        got = bpe.encode(frame(spark, texts), bpe.read_ranks(PATH))
        rows = got.withColumn("back", bpe.decoded(F.col("ids"), bpe.read_ranks(PATH))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    mine = sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), bytes(r["back"]).decode()) for r in rows)
    want = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), len(ids), np.array(ids, "<u4").tobytes(), t or ""))
    assert mine == sorted(want)


def test_empty_table_and_bad_ids(spark):
    ranks = bpe.read_ranks(PATH)
    assert bpe.encode(frame(spark, []), ranks).count() == 0
    ids = spark.createDataFrame([(None,), (np.array([50_300], "<u4").tobytes(),)], "ids binary")
    assert ids.where("ids IS NULL").select(bpe.decoded(F.col("ids"), ranks).alias("t")).first()["t"] is None
    with pytest.raises(Exception, match="not in the token-byte table"):
        ids.select(bpe.decoded(F.col("ids"), ranks)).collect()


def test_heap_and_plain_merges_agree(library, monkeypatch):
    ranks = bpe._ranks(bpe.read_ranks(PATH))
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abtheionr"), int(n))) for n in rng.integers(1, 90, 300)]
    plain = []
    for long in (10**9, 0):
        monkeypatch.setattr(bpe, "LONG", long)
        plain.append([bpe.merge(w.encode(), ranks) for w in words])
    assert plain[0] == plain[1] == [library.encode_ordinary(w) for w in words]


def test_a_word_is_shuffled_once_per_chunk_and_encoded_once(spark, monkeypatch):
    rows = [(i, "the same words all over the same words") for i in range(400)]
    chunks = frame(spark, rows).select("doc_id", "text").coalesce(1).mapInArrow(bpe._chunks(public_tokenizers.PATTERN), bpe.CHUNKS)
    words = chunks.mapInArrow(bpe._words, "word string, place long")
    assert chunks.count() == 1
    assert sorted(r["word"] for r in words.collect()) == sorted(["the", " same", " words", " all", " over", " the"])
