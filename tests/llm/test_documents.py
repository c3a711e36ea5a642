"""Measures and votes, fingerprints, line dedup, archives and mixing against plain Python."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import thue_morse
from pyspark.sql import functions as F

from wakeline.llm import lines, merkle, mixing, quality, warc
from wakeline.llm.common import fresh_path, union_labels

WORD = re.compile(r"[^\x20\x09-\x0D]+")


Doc = collections.namedtuple("Doc", "doc_id text")


def tables(odd, sample):
    return {"odd": odd, "sample": sample, "empty": odd.limit(0)}


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


# --- quality -----------------------------------------------------------------------------


def measured_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    wordy = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(wordy) - len(set(wordy)), len(repeated))


@pytest.mark.parametrize("which", ["odd", "sample", "empty"])
def test_measures(odd, sample, which):
    docs = tables(odd, sample)[which]
    got = sorted(map(tuple, quality.measures(docs).collect()), key=str)
    assert got == sorted([(r.doc_id, *measured_by_hand(r.text)) for r in docs.collect()], key=str)


def test_judge_keeps_base_failures_out_and_is_defined_everywhere(odd, sample):
    for docs in (odd, sample, odd.limit(0)):
        got = quality.judge(quality.measures(docs)).collect()
        assert len(got) == docs.count()
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert 0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(40000) < 0.7
    right = [0.95, 0.85, 0.75, 0.9, 0.6]
    votes = np.stack([np.where(rng.random(40000) < 0.3, 0, np.where((rng.random(40000) < a) == good, 1, -1)) for a in right], axis=1)
    table, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(table, counts)
    assert abs(model["share"] - 0.7) < 0.03
    for r, a in enumerate(right):
        spoken = model["rate"][0, r, :2]
        assert abs(spoken[0] / spoken.sum() - a) < 0.04


def test_posterior_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    got = quality.judge(quality.measures(docs)).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.label) for r in got) >= 0.95 * len(got)
    good = [r.kept for r in got if r.label]
    assert sum(good) >= 0.99 * len(good)


# --- fingerprints ------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "sample", "empty"])
def test_fingerprints_and_edits(odd, sample, which):
    docs = tables(odd, sample)[which]
    slim = docs.select("doc_id", "text")
    got = merkle.with_next(slim, merkle.SCHEMA, merkle.compared).collect()
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=order)
    expected = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[i - 1][1] or ""  # the one before, and before the first the last
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(key, got)) == sorted(map(key, expected))
    by_text = {}
    for r, e in zip(sorted(got, key=key), sorted(expected, key=key)):
        trees = merkle.Trees(pa.array([e[3], e[4], e[5]]))
        prints = [trees.fingerprint(i) for i in range(3)]
        assert (r.fingerprint, r.edited_fingerprint) == (prints[0], prints[1])
        assert r.near_edited == merkle.likeness(prints[0], prints[1]) and r.near_next == merkle.likeness(prints[0], prints[2])
        assert by_text.setdefault(e[3], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_patterns_that_cancel_out_in_a_polynomial(spark):
    """A string of 2,048 letters and its complement are different lines and different texts."""
    a = thue_morse(11)
    b = a.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{a}\n{b}"), (2, f"{b}\n{a}"), (3, f"{a} x {b}"), (4, f"{a} x {a}")], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in merkle.fingerprints(docs).collect()}
    assert len({p.split(".")[0] for p in prints.values()}) == 4
    assert merkle.likeness(prints[3], prints[4]) < 1 and merkle.differences(prints[3], prints[4])
    assert [r.n_dup_lines for r in quality.measures(docs).orderBy("doc_id").collect()] == [0, 0, 0, 0]


def test_differences_locate_an_edit():
    rnd = random.Random(2)
    text = "\n".join(" ".join(f"w{rnd.randint(0, 999)}" for _ in range(30)) for _ in range(60))
    at = 4000
    other = text[:at] + "CHANGED" + text[at:]
    a, b = (merkle.Trees(pa.array([x])).fingerprint(0) for x in (text, other))
    (span,) = merkle.differences(a, b)
    assert span[0] <= at <= span[1] and span[1] - span[0] < 600
    assert merkle.differences(a, a) == [] and merkle.likeness(a, b) > 0.9
    (span,) = merkle.differences(b, a)
    assert "CHANGED" in other[slice(*span)]


# --- lines -------------------------------------------------------------------------------


def deduped_by_hand(rows, least):
    """Every run of at least that many words, tried one by one."""
    distinct = sorted({(r.doc_id, r.text) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None))
    seen, out = {}, {}
    runs = {}
    for key in distinct:
        row = (key[1] or "").split("\n") if key[1] else []
        words = [len(WORD.findall(x)) for x in row]
        runs[key] = [(i, j, tuple(row[i:j])) for i in range(len(row)) for j in range(i + 1, len(row) + 1) if sum(words[i:j]) >= least]
    for n, key in enumerate(distinct):
        for i, j, content in runs[key]:
            seen.setdefault(content, (n, i))
    for n, key in enumerate(distinct):
        row = (key[1] or "").split("\n") if key[1] else []
        gone = set()
        for i, j, content in runs[key]:
            if seen[content] != (n, i):
                gone |= set(range(i, j))
        out[key] = (len(row), len(gone), "\n".join(x for k, x in enumerate(row) if k not in gone) if gone else key[1])
    return sorted([(str(r.doc_id), *out[r.doc_id, r.text]) for r in rows], key=str)


def deduped_pairwise(rows, least):
    """Every two places with one line, followed as far as they agree; for tables too long for every run."""
    distinct = sorted({(r.doc_id, r.text) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None))
    texts = [(key[1] or "").split("\n") if key[1] else [] for key in distinct]
    words = [[len(WORD.findall(x)) for x in row] for row in texts]
    places, out = {}, {}
    for n, (key, row) in enumerate(zip(distinct, texts)):
        gone, again = set(), set()
        for i, line in enumerate(row):
            for m, j in places.get(line, ()):
                k = 0
                while i + k < len(row) and j + k < len(texts[m]) and row[i + k] == texts[m][j + k]:
                    k += 1
                total = sum(words[n][i : i + k])
                gone |= set(range(i, i + k)) if total >= least else set()
                again |= set(range(i, i + k)) if total else set()
            places.setdefault(line, []).append((n, i))
        out[key] = (len(row), len(gone), "\n".join(x for k, x in enumerate(row) if k not in gone) if gone else key[1], len(again))
    return sorted([(str(r.doc_id), *out[r.doc_id, r.text]) for r in rows], key=str)


def test_both_checks_by_hand_agree():
    rnd = random.Random(9)
    rows = [Doc(i, "\n".join(rnd.choice(["a b", "c", "", "d e f", "b"]) for _ in range(rnd.randint(1, 9)))) for i in range(50)]
    for least in (1, 3, 8):
        assert [r[:4] for r in deduped_pairwise(rows, least)] == deduped_by_hand(rows, least)


@pytest.mark.parametrize("which", ["odd", "sample", "blank"])
@pytest.mark.parametrize("least", [1, lines.LEAST_WORDS, 50])
def test_line_dedup_of_whole_texts(spark, odd, sample, which, least):
    """The shipped floor and others, on texts of any length; runs of many lines, blank ones among them."""
    base = [f"line {i}" if i % 5 else "" for i in range(70)]
    blank = [(1, "\n".join(base)), (2, "\n".join(["x", *base[3:61], "y"])), (3, "\n" * 200 + "end"), (4, "\n" * 150 + "end\n" + "\n".join(base[:9]))]
    docs = {**tables(odd, sample), "blank": spark.createDataFrame(blank, "doc_id long, text string")}[which]
    docs = docs.withColumn("runs", F.lit("own")).withColumn("print", F.lit(1)).withColumn("c0", F.lit(2)).withColumn("__print", F.lit(3))
    got = lines.without_later_copies(docs, least)
    assert got.columns[: len(docs.columns)] == docs.columns
    found = got.collect()
    assert sorted(((str(r.doc_id), r["__n_lines"], r["__n_removed"], r.text, r["__n_repeated"]) for r in found), key=str) == deduped_pairwise(docs.collect(), least)
    assert {(r.runs, r.print, r.c0, r["__print"]) for r in found} <= {("own", 1, 2, 3)}


def test_ranks_are_a_suffix_array(spark):
    """Ranks of a level: places before it in the order of the first lines' ids, among places whose run recurs."""
    rnd = random.Random(3)
    texts = [[rnd.choice("abcd") for _ in range(rnd.randint(3, 30))] for _ in range(12)]
    docs = spark.createDataFrame([(i, "\n".join(t), i) for i, t in enumerate(texts)], "doc_id long, text string, print long")
    ids = {r.line_text: (r.a, r.b) for i, t in enumerate(texts) for r in lines.lines_of(docs.where(f"doc_id = {i}")).selectExpr(
        f"element_at(array({','.join(repr(x) for x in t)}), line + 1) as line_text", "a", "b").collect()}
    for k, level in enumerate(lines.suffix_levels(docs, 6)):
        size = 1 << k
        runs = {(d, i): tuple(ids[x] for x in t[i : i + size]) for d, t in enumerate(texts) for i in range(len(t) - size + 1)}
        recur = {p: r for p, r in runs.items() if sum(q == r for q in runs.values()) > 1}
        order = sorted(recur.values())
        assert {(r.doc_id, r.line): r["rank"] for r in level.collect()} == {p: order.index(r) for p, r in recur.items()}
    assert k >= 2


@pytest.mark.parametrize("which", ["odd", "sample", "small", "empty"])
def test_line_dedup(spark, odd, sample, which):
    rnd = random.Random(4)
    texts = ["\n".join(rnd.choice(["a b", "c", "", "d e f", "g h i j k l m n", "b"]) for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    small = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = {**tables(odd, sample), "small": small}[which]
    if which == "sample":
        docs = docs.where("length(text) < 6000")  # the check by hand is of cubic cost
    least = 8 if which == "small" else 50
    got = lines.without_later_copies(docs, least)
    assert set(docs.columns) <= set(got.columns)
    got = sorted(((str(r.doc_id), r["__n_lines"], r["__n_removed"], r.text) for r in got.collect()), key=str)
    assert got == deduped_by_hand(docs.collect(), least)


def test_short_runs_are_found_and_the_floor_only_decides_what_goes(spark):
    floor = lines.LEAST_WORDS
    long = " ".join(f"w{i}" for i in range(floor))
    texts = ["one\n\nshort line\n" + long, "x\none\ny z\n" + long + "\nshort line", "none of it", "\n\nshort line\nq\nq"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lines.without_later_copies(docs).orderBy("doc_id").collect()
    assert [(r["__n_repeated"], r["__n_repeated_runs"]) for r in got] == [(0, 0), (3, 2), (0, 0), (3, 2)]
    assert [(r["__n_removed"], r["__n_runs"]) for r in got] == [(0, 0), (1, 1), (0, 0), (0, 0)]
    assert [r.text for r in got] == [texts[0], "x\none\ny z\nshort line", texts[2], texts[3]]


# --- archives ----------------------------------------------------------------------------


def test_archives_round_trip(spark):
    rows = [(1, "http://a", "x"), (5, "http://b c\r\nX: y", "x"), (3, None, "y"), (2, "u", None), (4, "u", ""), (None, "u", "z"), (7, "u", "z"), (7, "u", "z")]
    rows += [(100 + i, "u", "same") for i in range(50)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, sha string")
    for table in (pages, pages.limit(0)):
        folder = fresh_path(spark, "warc")
        assert (warc.write_archives(table, folder, archive_bytes=4000).agg(F.sum("n_records")).first()[0] or 0) == table.count()
        got = sorted(map(tuple, warc.read_archives(spark, folder).collect()), key=str)
        first = {}
        for page_id, _, html, _ in table.collect():
            if page_id is not None:
                first[html or ""] = min(first.get(html or "", page_id), page_id)
        expected, done = [], set()
        for page_id, _, html, _ in table.collect():
            body = html or ""
            lead = page_id == first[body] and body not in done
            if lead:
                done.add(body)
            expected.append((page_id, len(body), warc.digest(body.encode()), "response" if lead else "revisit", None if lead else first[body]))
        assert got == sorted(expected, key=str)


def test_short_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(i, "u", "ab") for i in range(4)], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    warc.write_archives(pages, folder, least=3)
    assert {r.record_type for r in warc.read_archives(spark, folder).collect()} == {"response"}


# --- mixing ------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "sample", "empty"])
def test_mix(odd, sample, which):
    docs = tables(odd, sample)[which]
    got = mixing.mix_sources(docs).collect()
    assert sorted(mixing.mix_sources(docs).collect(), key=str) == sorted(got, key=str)
    assert len(got) == docs.count()
    sizes, targets, taken, largest = {}, {}, {}, {}
    for r in got:
        assert r["__size"] == len(WORD.findall(r.text or "")) and 0 <= r["__copies"] <= 2
        sizes[r.source] = sizes.get(r.source, 0) + r["__size"]
        taken[r.source] = taken.get(r.source, 0) + r["__size"] * r["__copies"]
        largest[r.source] = max(largest.get(r.source, 0), r["__size"])
        targets[r.source] = r["__target"]
    # Share by weight, cap, and share the excess again until nothing is above.
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped, budget = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            break
        capped |= {s: 2.0 * sizes[s] for s in above}
    for s in names:
        assert targets[s] == pytest.approx(capped.get(s, share.get(s)), rel=1e-9, abs=1e-9)
        assert abs(taken[s] - targets[s]) <= largest[s]


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randint(0, 90), rnd.randint(0, 90)) for _ in range(40)] + [(500, 500 + i) for i in range(1, 200)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.label for r in union_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert union_labels(spark.createDataFrame([], "a long, b long")).collect() == []
