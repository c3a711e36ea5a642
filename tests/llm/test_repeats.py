"""Repeated strings against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest

from wakeline.llm import repeats


def by_hand(rows, length):
    seen = {}
    texts = [(r.text or "").encode() for r in rows]
    for data in texts:
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r, data in zip(rows, texts):
        gone = np.zeros(len(data) + 1, np.int8)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((r.doc_id, len(data), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mixed(n, seed, alphabet="abc"):
    rnd = random.Random(seed)
    make = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    shared = [make(rnd.randint(30, 90)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rnd.choice([*shared, make(rnd.randint(1, 80)), "é" * rnd.randint(1, 9)]) for _ in range(rnd.randint(1, 7))]
        texts.append("".join(parts))
    return texts + ["a" * 200, "ab" * 120, "", "a" * 60, "x" + "ab" * 90 + "y", "abcab" * 40 + shared[0]]


@pytest.mark.parametrize("which", ["odd", "mixed", "mixed-long", "sample", "empty"])
def test_every_repeated_window_goes(spark, odd, sample, which):
    length, gram = (400, 128) if which in ("odd", "sample", "empty") else (48, 16) if which == "mixed" else (60, 40)
    made = spark.createDataFrame([(i % 90, t) for i, t in enumerate(mixed(100, 5))], "doc_id long, text string")
    docs = {"odd": odd, "mixed": made, "mixed-long": made, "sample": sample, "empty": odd.limit(0)}[which]
    got = repeats.without_repeats(docs, length, gram).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(docs.collect(), length)


def test_column_by_column_order_finds_equal_windows():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (40, 14)).astype(np.uint16)
    marks = repeats.repeated_windows(rows, np.zeros(40, int), np.full(40, 6), 8, 6)
    for before in range(7):
        windows = [tuple(r[6 - before : 14 - before]) for r in rows]
        assert marks[:, before].tolist() == [windows.count(w) > 1 for w in windows]


@pytest.mark.parametrize("most", [0, 3, 20])
def test_common_anchors_are_not_one_group(spark, monkeypatch, most):
    """A passage with other surroundings in every text, with and without groups too large for one task."""
    rnd = random.Random(8)
    make = lambda k: "".join(rnd.choice("abcdefg") for _ in range(k))
    passage = make(70)
    texts = [make(rnd.randint(0, 60)) + passage[rnd.randint(0, 9) :] + make(rnd.randint(0, 60)) for _ in range(80)] + mixed(60, 5)
    texts += [texts[3], "x" + texts[4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = repeats.without_repeats(docs, 48, 16, most=most).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(docs.collect(), 48)
    # No task orders more stretches than it may hold of one hash.
    monkeypatch.setattr(repeats, "TOGETHER", 1)
    monkeypatch.setattr(repeats, "covered", lambda group, *_: {"print": [b"n"], "start": [len(group["at"])], "end": [0]})
    rows = docs.selectExpr("unhex(md5(text)) as print", "text")
    sizes = [r.start for r in repeats.spans(rows, 48, 16, most)[1].where("end = 0").collect()]
    assert max(sizes, default=0) <= most
