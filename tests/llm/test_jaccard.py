"""Components against all pairs compared one by one."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import thue_morse

from wakeline.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(fold)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_hand(rows):
    sets = [shingles(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 5 >= 4 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    low = {}
    for i, r in enumerate(rows):
        if sets[i] and r.doc_id is not None:
            low[find(i)] = min(low.get(find(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s), low.get(find(i)) if s else r.doc_id) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def near_copies(n, seed):
    """Groups of copies with edits, chains of small edits, and passages shared by unlike texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 400)}"
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rnd.randint(3, 80))]
        for _ in range(rnd.choice((1, 1, 2, 6, 15))):
            texts.append(" ".join(base))
            if rnd.random() < 0.8:
                base = list(base)  # a chain: the next one is an edit of this one
                base[rnd.randrange(len(base))] = word()
        if rnd.random() < 0.3:
            texts.append(" ".join([*base[:8], *passage, word()]))
    return texts


@pytest.mark.parametrize("which", ["odd", "near", "sample", "empty"])
def test_components(spark, odd, sample, which):
    near = spark.createDataFrame(list(enumerate(near_copies(60, 3))), "doc_id long, text string")
    docs = {"odd": odd, "near": near, "sample": sample, "empty": odd.limit(0)}[which]
    got = sorted(map(tuple, jaccard.components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == by_hand(docs.collect())


def test_pivots_meet_every_open_pair(spark):
    """A group streamed in small batches: pairs of a pivot with all others, across batches."""
    rows = [(7, node, 10, node) for node in range(50)] + [(8, 3, 10, 3), (9, 1, 10, 1), (9, 2, 30, 2), (9, 5, 11, 1)]
    # Of twenty tokens each three have passed: at most 17 are common, and 18 would have to be.
    rows += [(10, 60, 20, 60), (10, 61, 3 << 32 | 20, 61)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = jaccard.pairs_in_groups(spark.createDataFrame(rows, "token long, node long, at long, comp long"), 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = {(r.a, r.b) for r in got if r.kind == 0}
    assert pairs == {(a, b) for a in range(3) for b in range(a + 1, 50)}
    assert sorted((r.b, r.a) for r in got if r.kind == 1) == [(7, x) for x in range(3, 50)]


def test_prefixes_keep_every_pair_under_every_order():
    rng = np.random.default_rng(2)
    level = np.zeros(jaccard.BUCKETS, np.uint8)
    level[: jaccard.BUCKETS // 3] = 5
    base = rng.integers(0, 2**52, 200, dtype=np.uint64)
    for drop in (0, 5, 11, 20, 22):
        a, b = np.sort(base), np.sort(np.concatenate((base[drop:], rng.integers(0, 2**52, drop // 2, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        similar = 100 * both >= 80 * (len(a) + len(b) - both)
        for order in range(3):
            values, first = jaccard.prefix(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), level, order, 80)
            shared = np.intersect1d(values[: first[1]], values[first[1] :])
            assert len(shared) or not similar


def test_first_common_token_leaves_enough(seed=4):
    """The group of a similar pair's first common token forms the pair."""
    rng = np.random.default_rng(seed)
    level = np.zeros(jaccard.BUCKETS, np.uint8)
    level[: jaccard.BUCKETS // 2] = 3
    base = rng.integers(0, 2**52, 300, dtype=np.uint64)
    for _ in range(60):
        a = np.unique(base[rng.random(300) < rng.uniform(0.8, 1)])
        b = np.unique(np.concatenate((base[rng.random(300) < rng.uniform(0.8, 1)], rng.integers(0, 2**52, 20, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        values, first = jaccard.prefix(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), level, 0, 80)
        x, y = values[: first[1]].tolist(), values[first[1] :].tolist()
        i, j = min((x.index(t), y.index(t)) for t in set(x) & set(y))
        assert 180 * min(len(a) - i, len(b) - j) >= 80 * (len(a) + len(b))


def test_patterns_that_cancel_out_in_a_polynomial(spark):
    """A string of 2,048 letters and its complement: different words, so different shingles."""
    a = thue_morse(11)
    b = a.translate(str.maketrans("ab", "ba"))
    texts = [f"{w} c d e f g h" for w in (a, b)] + [a, b] + [f"x {w[:64]} y z" for w in (a, b)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, jaccard.components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == by_hand(docs.collect()) and len({r[2] for r in got}) == len(texts)


def test_one_of_each(spark, odd):
    rows = [(5, "a b c d e f g h", "x"), (2, "A b c d e f g h", "y"), (9, "other words here", "z"), (11, None, "q"), (12, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 9, 11, 12]
    assert jaccard.one_of_each(odd).count() <= odd.count()


def test_short_sequences():
    values, first = jaccard.sets_of(pa.array(["a", "A", "a b", "b a", None, " ", "a b c d e", "a b c d e f"]))
    sets = [tuple(values[first[i] : first[i + 1]]) for i in range(8)]
    assert sets[0] == sets[1] != sets[2] != sets[3] and sets[4] == sets[5] == ()
    assert len(sets[6]) == 1 and len(sets[7]) == 2 and sets[6][0] in sets[7]


@pytest.mark.parametrize("n", [4096, 10_000])
def test_full_batches_of_short_texts(spark, n):
    """As many neighbouring texts as a batch of texts holds, some of them empty, the last ones linked with others."""
    texts = ["" if i % 7 == 3 else f"a{i} b c d e f{i}" for i in range(n)]
    texts[0] = texts[4095] = texts[n - 1] = "one of those that are alike in all words"
    values, first = jaccard.sets_of(pa.array(texts[:4096]))
    assert first[-1] == len(values) and np.diff(first).tolist() == [len(shingles(t)) for t in texts[:4096]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(docs).collect()}
    assert got == {i: (len(shingles(t)), 0 if i in (4095, n - 1) else i) for i, t in enumerate(texts)}


def test_halves_that_coincide_are_allowed_for(spark, monkeypatch):
    """With halves of few bits many coincide; pairs of templates with a few rare words of their own are still linked."""
    tokens = np.array([1, 1 << 32 | 1, 2, 1, 5, 5, 5], np.uint64)
    assert jaccard.coinciding(tokens, np.array([0, 3, 3, 7])).tolist() == [1, 0, 2]
    plain = jaccard.prefix

    def few_bits(values, first, level, order, percent):
        tokens, begins = plain(values, first, level, order, percent)
        return (tokens if order == 0 else (tokens >> np.uint64(8) << np.uint64(32)) | (tokens & np.uint64(7))), begins

    monkeypatch.setattr(jaccard, "prefix", few_bits)
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(600)]
    texts = []
    for i in range(12):
        own = list(base)
        for at in rnd.sample(range(600), 5):
            own[at] = f"own{i}x{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, jaccard.components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == by_hand(docs.collect()) and len({r[2] for r in got}) == 1
