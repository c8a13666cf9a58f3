"""Brown classes and the toxicity machine."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np

from riskloom.llm import brown, toxicity
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, seq string, score double"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1.0) for i, t in rows], DOCS)


def test_brown_counts_equal_brute_force_and_model_beats_the_unigram(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in brown.score(docs, passes=4).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {r["doc_id"]: [*re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(lower)), None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    rows = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_brown_probabilities_add_up_to_one(spark):
    rng = np.random.default_rng(3)
    docs = frame(spark, [(i, " ".join(rng.choice(["aa", "bb", "ab", "ca", "da"], 30))) for i in range(40)])
    # One-word texts: P(word) * P(end | word) summed over everything that follows is at most 1.
    k, share = 4, 0.05
    chunks = brown.stored(docs.selectExpr("doc_id", "false AS held_out", "text").mapInArrow(brown.encode, brown.ENCODED), "t")
    totals, tokens = brown.word_totals(chunks, share)
    vocab = brown.vocabulary(totals, tokens, 40, share)
    model = brown.cluster(brown.sequences(chunks, totals, vocab), vocab, k, 3)
    assert np.allclose((10.0**model.step).sum(1), 1)
    per_class = np.bincount(model.classes, 10.0**model.emit, k)
    assert np.allclose(per_class[np.bincount(model.classes, minlength=k) > 0], 1)


def test_exchange_raises_the_likelihood_of_a_structured_text():
    rng = np.random.default_rng(5)
    k, units = 4, 30
    line = 1 + 3 * rng.integers(0, 9, 5000) + np.arange(5000) % 3
    line = (line * 11) % 29 + 1  # kinds of words follow each other in turn
    classes = 1 + np.arange(units) % (k - 1)
    classes[0] = 0

    def counts(classes):
        out = np.zeros((units, 2 * k), np.int64)
        np.add.at(out, (line[1:], classes[line[:-1]]), 1)
        np.add.at(out, (line[:-1], k + classes[line[1:]]), 1)
        return out

    before = brown.likelihood(brown.class_table(counts(classes), classes, k))
    moved = brown.exchange(counts(classes), classes, k, 0)
    after = brown.likelihood(brown.class_table(counts(moved), moved, k))
    assert after > before and moved[0] == 0 and (moved[1:] > 0).all()


def test_rare_words_are_clustered_by_their_own_neighbours(spark):
    """All rare words have one ending; some follow "the", the others "of"."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"the a{a}xx of b{b}xx" for a, b in rng.integers(0, 40, (25, 2)))) for i in range(60)]
    rows += [(1000, "the a1xx of b1xx"), (1001, "the b1xx of a1xx")]
    got = {r["doc_id"]: r for r in brown.score(frame(spark, rows), share=0.1, k=6, passes=6).collect()}
    assert got[1000]["score"] > got[1001]["score"] + 1
    chunks = brown.stored(frame(spark, rows).selectExpr("doc_id", "false AS held_out", "text").mapInArrow(brown.encode, brown.ENCODED), "t")
    totals, tokens = brown.word_totals(chunks, 0.1)
    vocab = brown.vocabulary(totals, tokens, len(rows), 0.1)
    counts = Counter(w for _, text in rows for w in text.split())
    assert set(vocab.units) == {"=the", "=of", "~xx"} and vocab.rare == len(counts) - 2
    model = brown.cluster(brown.sequences(chunks, totals, vocab), vocab, 6, 6, totals)
    first = totals.where("first AND number >= 0").select("number", "c").toPandas()
    rare = brown._units(first["number"].to_numpy(), vocab) - vocab.head
    assert sorted(rare) == list(range(vocab.rare))
    sums = np.bincount(model.classes, 10.0**model.emit, 6)
    sums += np.bincount(model.rare[rare], (first["c"] + brown.SMOOTH) * 10.0 ** model.scale[model.rare[rare]], 6)
    assert np.allclose(sums[np.bincount(np.r_[model.classes, model.rare], minlength=6) > 0], 1)


def test_gains_of_rare_units_are_those_of_the_likelihood():
    rng = np.random.default_rng(7)
    k, units = 5, 30
    classes = np.r_[0, 1 + rng.integers(0, k - 1, units - 1)]
    texts = [rng.integers(1, units - 2, 6).tolist() for _ in range(80)] + [[28]] * 3 + [[29]] * (brown.FEW + 8)

    def pairs(classes):
        out = np.zeros((k, k))
        for text in texts:
            line = classes[[0, *text, 0]]
            np.add.at(out, (line[:-1], line[1:]), 1)
        return out

    base = pairs(classes)
    with_class = np.concatenate([base, base.T])[:, None, :]
    known = brown._f(with_class + np.arange(brown.FEW + 1)[:, None]) - brown._f(with_class)
    counts = np.zeros((2, 2 * k), np.int64)
    counts[:, 0] = counts[:, k] = 3, brown.FEW + 8  # END alone on either side
    got = brown._gains(counts, classes[28:], base, known)
    for i, u in enumerate((28, 29)):
        want = np.zeros(k)
        for b in range(1, k):
            moved = classes.copy()
            moved[u] = b
            want[b] = brown.likelihood(pairs(moved))
        assert np.allclose(np.diff(got[i, 1:]), np.diff(want[1:]))


def test_brown_edges(spark):
    rows = [(None, None), (1, ""), (2, "   "), (3, "one Two two"), (3, "one Two two"), (4, "w " * 30000)]
    got = brown.score(frame(spark, rows), passes=2).collect()
    assert len(got) == 6 and sorted(r["n_tokens"] for r in got) == [1, 1, 1, 4, 4, 30001]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert brown.score(frame(spark, []), passes=1).count() == 0
    only_held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    lone = brown.score(frame(spark, [(only_held, "never seen")]), passes=1).collect()[0]
    assert (lone["train_tokens"], lone["n_known"], lone["base_score"]) == (0, 0, 0.0)


def test_kernel_keeps_similarity_under_gaps():
    k = toxicity._kernel(["wretch", "wr-etch", "wre.tch", "garden"], ["wretch"])[:, 0]
    assert math.isclose(k[0], 1, rel_tol=1e-5) and k[1] > 0.25 and k[2] > 0.25 and k[3] < 0.05


def test_every_word_has_similarity_one_with_itself():
    """The plain kernel: entries by subsequence and place of its class in the table, weights added up."""
    words = ["aaaaaa", "banana", "abbc", "idiot", "x", "mississippi", "w" * 300]
    assert np.allclose(np.diag(toxicity._kernel(words, words)), 1, rtol=1e-5)
    for word, length in zip(words, toxicity.norms(words)):
        entries = Counter()
        for _, slots, weight in toxicity.features([word]):
            for slot in slots.tolist():
                entries[slot] += weight
        assert math.isclose(length, math.sqrt(sum(v * v for v in entries.values())), rel_tol=1e-9)


def test_scores_equal_the_kernel_expansion_and_do_not_depend_on_batches(spark):
    docs, labels = planted(spark, 80)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(frame(spark, docs), known)
    weights, bias, a, b = model
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(frame(spark, docs), model).collect()}
    for i, text in docs:
        worst = max(toxicity.word_scores([w], weights, bias)[0] for w in toxicity.units(text))
        assert math.isclose(got[i], 1 / (1 + math.exp(-(a * min(max(worst, -2), 2) + b))), rel_tol=1e-5)
    kept, toxicity.KEPT = toxicity.KEPT, 3
    try:
        again = {r["doc_id"]: r["score"] for r in toxicity.score_texts(frame(spark, docs).coalesce(1), model).collect()}
    finally:
        toxicity.KEPT = kept
    assert all(math.isclose(again[i], got[i], rel_tol=1e-6) for i in got)


def test_a_repeated_sampled_id_is_one_row_of_the_sample(spark, monkeypatch):
    docs, labels = planted(spark, 60)
    sizes = []
    real = toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, name: (lambda t: (sizes.append(t.count()) if name == "toxic-sample" else None, t)[1])(real(df, name)))
    toxicity.train(frame(spark, docs + docs[:5] * 50), spark.createDataFrame(labels, "doc_id long, toxic int"), sample=10)
    assert sizes and sizes[0] <= 20


def test_a_rare_insult_is_told_behind_many_forms_of_another():
    rng = np.random.default_rng(6)
    letters = list("abcdefgilmnoprstu")
    forms = sorted({"wretch" + "".join(rng.choice(letters, 3)) for _ in range(260)})[:240]
    plain = sorted({"".join(rng.choice(list("bcdfglmnprst")) + rng.choice(list("aeiou")) for _ in range(rng.integers(1, 4))) for _ in range(600)})
    rare = ["zubqokh", "jyxvak"]
    assert len(forms) > toxicity.LANDMARKS
    weights, bias = toxicity.fit_machine(forms + rare, plain)
    assert (toxicity.word_scores(rare + forms, weights, bias) > 0).all() and (toxicity.word_scores(plain, weights, bias) < 0).all()
    marks = toxicity.covering(forms + rare, toxicity.LANDMARKS)
    assert marks[: toxicity.LANDMARKS] == forms[: toxicity.LANDMARKS] and set(rare) <= set(marks)
    assert toxicity.covering(rare, toxicity.LANDMARKS) == rare


def planted(spark, n=240):
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("bcdfglmnprst")) + rng.choice(list("aeiou")) for _ in range(rng.integers(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 40))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(int(rng.integers(0, 40)), str(rng.choice(["wretchx", "vermink"])))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_finds_planted_insults_and_variants(spark):
    docs, labels = planted(spark)
    # The held-out labels are all wrong here: they must not matter.
    known = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    truth = dict(labels)
    more = [(1000, "ba be w r e t c h x bo"), (1001, "ba wretch*x bi"), (1002, ""), (1003, None), (None, "ba be bi"), (1004, "ba " * 20000 + "wretchx")]
    model = toxicity.train(frame(spark, docs), spark.createDataFrame(known, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score_texts(frame(spark, docs + more), model).collect()}
    assert all(got[i]["predicted"] == y for i, y in truth.items())
    assert [got[i]["predicted"] for i in (1000, 1001, 1002, 1003, None, 1004)] == [1, 1, 0, 0, 0, 1]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, [(1, "a b")]), none)
    assert [r["score"] for r in toxicity.score_texts(frame(spark, [(1, "a b"), (2, None)]), model).collect()] == [0.5, 0.5]
    assert toxicity.score_texts(frame(spark, []), model).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.clean_documents(frame(spark, [(1, "a b"), (2, None)]), nulls.where("toxic = 0")).columns == DOCS.replace(",", "").split()[::2]
