"""The chain model against enumeration of all labellings, and its accuracy on documents it has not seen."""

import itertools
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wakeline.llm import language


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(0)
    k, lengths = 3, np.array([5, 4, 1])
    scores, start, moves = rng.normal(size=(3, 5, k)), rng.normal(size=k), rng.normal(size=(k, k))
    marginal, expected, norm = language.forward_backward(scores, lengths, start, moves)
    total = np.zeros((k, k))
    for c, n in enumerate(lengths):
        weights, paths = [], list(itertools.product(range(k), repeat=int(n)))
        for path in paths:
            s = start[path[0]] + sum(scores[c, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            weights.append(np.exp(s))
        weights = np.array(weights)
        assert norm[c] == pytest.approx(np.log(weights.sum()))
        for t in range(n):
            for y in range(k):
                assert marginal[c, t, y] == pytest.approx(sum(w for w, p in zip(weights, paths) if p[t] == y) / weights.sum())
        for w, p in zip(weights / weights.sum(), paths):
            for a, b in zip(p, p[1:]):
                total[a, b] += w
    assert np.allclose(expected, total)
    assert not marginal[2, 1:].any()


def fitted(lengths, k=2, rounds=3):
    """A model of chains of these lengths over twenty words."""
    rng = np.random.default_rng(0)
    model = language.Model([f"l{i}" for i in range(k)], {})
    words, code = [f"w{i}" for i in range(20)], rng.integers(0, 20, sum(lengths))
    model.fit(words, code, np.cumsum(lengths) - lengths, rng.integers(0, k, len(lengths)), rounds)
    return model


@pytest.mark.parametrize("cells", [1, 100])
def test_learning_in_blocks_is_learning_at_once(monkeypatch, cells):
    lengths = np.random.default_rng(1).integers(1, 12, 60)
    monkeypatch.setattr(language, "CELLS", 1 << 30)
    whole = fitted(lengths)
    monkeypatch.setattr(language, "CELLS", cells)
    parts = fitted(lengths)
    for a, b in ((whole.weights, parts.weights), (whole.start, parts.start), (whole.moves, parts.moves)):
        assert a.any() and np.allclose(a, b, rtol=0, atol=1e-9)


def test_learning_pads_no_short_chain_to_the_longest():
    """The driver learns: its memory follows the words, not the chains times the longest of them."""
    tracemalloc.start()
    try:
        fitted(np.array([64] + [2] * 20_000), rounds=1)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_chains_cover_every_word():
    texts = pa.array(["Ab cd. Ef-gh\nÉtè 12 x", None, "", "... 1", " ".join(["w"] * 200)])
    words, text, starts = language.chains_of(texts)
    assert words.cast(pa.string()).to_pylist()[:6] == ["Ab", "cd", "Ef", "gh", "Étè", "x"]
    assert np.bincount(text, minlength=5).tolist() == [6, 0, 0, 0, 200]
    assert np.diff(np.append(starts, 206)).tolist() == [2, 2, 2, 64, 64, 64, 8]


def test_words_of_a_switched_text_get_their_own_language():
    chains = [("en", i, f"the and of with this{i % 7}ing house") for i in range(40)] + [("de", i, f"der und von mit dies{i % 7}ung haus") for i in range(40)]
    model = language.learned(chains, ["de", "en"])
    sums, letters = model.label(pa.array(["the and of with house. der und von mit haus", "der und", "123"]), {})
    assert abs(sums[0, 0] / letters[0] - 15 / 33) < 0.1 and sums[1, 0] > 0.9 * letters[1] and letters[2] == 0


def test_switches_inside_a_sentence(spark):
    """Words of two languages in one sentence, in stretches of 5 to 25 words; learned from the shipped sample."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.learn(docs.where(~language.is_held_out("doc_id")))
    words = {}
    for r in docs.where(language.is_held_out("doc_id")).where("lang is not null and text is not null").collect():
        words.setdefault(r.lang, []).extend(w for w in re.findall(r"[^\W\d_]+", r.text))
    rnd = random.Random(1)
    for a, b in itertools.combinations(sorted(words), 2):
        text, truth = [], {a: 0, b: 0}
        for k in range(40):
            lang = (a, b)[k % 2]
            at = rnd.randrange(len(words[lang]) - 25)
            piece = words[lang][at : at + rnd.randint(5, 25)]
            text += piece
            truth[lang] += sum(map(len, piece))
        sums, total = model.label(pa.array([" ".join(text)]), {})
        share = dict(zip(model.languages, sums[0] / total[0]))
        assert abs(share[a] - truth[a] / sum(truth.values())) < 0.03 and share[a] + share[b] > 0.97


def test_a_rare_language_is_learned(spark):
    """One of a thousand labels: the sample is shared out among languages."""
    rows = [(i, f"the house and the garden of number {i} with this", "en") for i in range(3000)]
    rows += [(5000 + i, "haus und garten der nummer mit diesem", "de") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, sample=200)
    found = language.predict(spark.createDataFrame([(1, "und der garten"), (2, "the garden")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in found.orderBy("doc_id").collect()] == ["de", "en"]


def test_unlabelled_documents_and_clashing_names_are_kept(spark):
    docs = spark.createDataFrame([(i, f"some words {i}", None, -5.0, "own") for i in range(20)], "doc_id long, text string, lang string, score double, lang_pred string")
    assert sorted(map(tuple, language.keep_known(docs).collect())) == sorted(map(tuple, docs.collect()))
    labelled = docs.withColumn("lang", F.lit("en"))
    kept = language.keep_known(labelled)
    assert kept.columns == docs.columns and {(r.score, r.lang_pred) for r in kept.collect()} == {(-5.0, "own")}


def test_all_letters_of_a_word_count():
    long = "ab" * 20
    assert len(language.features(long, {})) == len(long) + 9
    assert language.features(long[:20] + "q" + long[20:], {}) != language.features(long, {})


def test_odd_texts(odd):
    model = language.learn(odd.select("doc_id", "text", "lang"))
    got = language.predict(odd.withColumnRenamed("n_chars", "score"), model).collect()
    assert len(got) == odd.count()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id != 3}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in texts:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")), r
    none = language.learn(odd.limit(0).select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.predict(odd, none).collect()} == {"und"}
    assert language.predict(odd.limit(0), model).collect() == []
    kept = language.keep_known(odd)
    assert kept.columns == odd.columns and 0 < kept.count() < odd.count()


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = [r for r in language.op6_language(spark, folder).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert len(held) > 100 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
