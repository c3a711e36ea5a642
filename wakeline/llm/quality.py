"""Weak supervision for document quality: rules vote, expectation-maximisation weighs them.

Each rule says good (1), bad (-1) or abstains (0). How often a rule is right, and what share of documents is
good, are estimated without labels by expectation-maximisation (the one of Dawid and Skene; an abstention
says nothing). A document's likelihood depends on its votes alone, so Spark counts the documents of each
combination of votes over all that pass the base rule, and the estimation runs on those counts: at most 3^rules rows
whatever the input (243 with five rules). The posterior of each document is then a sum of logarithms
in Spark.

Votes alone do not tell a defect that one rule finds from a rule that is often wrong. So the estimation is of the most
probable rates under a prior, ``START_RATES`` with the weight of a share ``PRIOR`` of all documents: a defect found is
seldom a mistake, a defect not found says little. The same share at every size, so that more documents do not change
what is decided. A rule whose votes are all alike carries no weight: only votes that tell documents apart do.

Defined cases: a null, empty or blank text has no words, all measures 0, and fails the base rule; repeated rows vote
each; an empty table gives an empty one; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, read, stored
from wakeline.llm.words import grams, hashes, owners, raw, runs, slices, words

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
#: Posterior from which a document is kept.
KEEP = 0.5
#: Weight of the prior, as a share of the documents.
PRIOR = 0.04
#: Documents that the rates among bad ones start as, so that none of them is 0 or 1.
SMOOTH = 1.0
START_GOOD = 0.8
#: Rates of good and bad votes that the estimation starts from, among good and among bad documents: a defect
#: found is seldom a mistake, a defect not found says little.
START_RATES = ((0.998, 0.002), (0.6, 0.4))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure_text(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = raw(column)
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    of_word = owners(first)
    hashed = hashes(data, starts, ends)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # bytes that begin a code point
    chars = np.bincount(of_word, (lead[ends] - lead[starts]).astype(np.float64), n).astype(np.int64)
    marks = np.concatenate(([0], np.cumsum(_SYMBOL[data])))

    # Lines with a word, by the hash of all their bytes.
    a, b, line_first = runs(data != 10, offsets)
    of_line = owners(line_first)
    wordy = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, of_line = a[wordy], b[wordy], of_line[wordy]
    key = grams_of(hashes(data, a, b), of_line)
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    dup_lines = np.bincount(of_line[order[1:][again]], minlength=n)

    # Three-word windows that lie in one text; the words of those found twice or more.
    windows = grams(hashed, 3)
    inside = of_word[: len(windows)] == of_word[2:] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    at = at[repeated(grams_of(windows[at], of_word[at]))]
    covered = np.zeros(len(starts) + 2, bool)
    for k in range(3):
        covered[at + k] = True
    return {
        "n_words": np.diff(first),
        "word_chars": chars,
        "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]],
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(of_word, covered[: len(starts)].astype(np.float64), n).astype(np.int64),
    }


def grams_of(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys told apart by text."""
    return keys ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    data = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        text = batch.column("text")
        for i, j in slices(text):
            yield {"doc_id": batch.column("doc_id").slice(i, j - i)} | measure_text(text.slice(i, j - i))

    return by_batch(data, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES), work)


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)).cast("int")


def rules() -> dict[str, Column]:
    """The voting rules, on shares of counts, in whole numbers. ``bad`` is looked at first.

    One rule a count, as the estimation takes votes of a document to be independent given its quality.
    """
    n, chars, marks = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    dup, rep = F.col("n_dup_lines"), F.col("n_repeat_words")
    return {
        "length": vote(n < 50, n >= 100),
        "word_length": vote((chars < 3 * n) | (chars > 10 * n), (2 * chars >= 7 * n) & (chars <= 8 * n)),
        "symbols": vote(10 * marks > n, 50 * marks <= n),
        "dup_lines": vote(20 * dup > n, 200 * dup <= n),
        "repeats": vote(100 * rep > 30 * n, 100 * rep <= 10 * n),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> dict:
    """Expectation-maximisation over combinations of votes and how many documents have each.

    For each rule: the shares of good and bad among its votes, for good and for bad documents. An abstention says
    nothing.
    """
    votes, counts = np.atleast_2d(votes), np.asarray(counts, np.float64)
    k = votes.shape[1]
    onehot = np.stack([votes == v for v in (1, -1)], axis=2).astype(np.float64)  # combination, rule, vote
    share = START_GOOD
    rate = np.zeros((2, k, 2))
    rate[:] = np.array(START_RATES)[:, None]
    total, before = counts.sum(), -np.inf
    if not total:
        return {"share": share, "rate": rate}
    prior = rate.copy()
    for _ in range(rounds):
        good = math.log(share) + np.einsum("cri,ri->c", onehot, np.log(rate[0]))
        bad = math.log(1 - share) + np.einsum("cri,ri->c", onehot, np.log(rate[1]))
        both = np.logaddexp(good, bad)
        now = float((counts * both).sum())
        p = np.exp(good - both)
        for c, weight in ((0, counts * p), (1, counts * (1 - p))):
            said = np.einsum("c,cri->ri", weight, onehot) + (PRIOR * total, SMOOTH)[c] * prior[c]
            rate[c] = said / said.sum(axis=1, keepdims=True)
        share = float(((counts * p).sum() + SMOOTH * START_GOOD) / (total + SMOOTH))
        if abs(now - before) <= tolerance * abs(now):
            break
        before = now
    return {"share": share, "rate": rate}


def posterior(model: dict, names: list[str]) -> Column:
    """Probability of being good from the votes ``__<rule>``, as one sum of log ratios."""
    ratio = np.log(model["rate"][0]) - np.log(model["rate"][1])
    score = F.lit(math.log(model["share"]) - math.log(1 - model["share"]))
    for r, name in enumerate(names):
        v = F.col(f"__{name}")
        score = score + F.when(v > 0, float(ratio[r, 0])).when(v < 0, float(ratio[r, 1])).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def judge(measured: DataFrame, keep: float = KEEP) -> DataFrame:
    """``measured`` with ``base_failed``, ``quality`` (posterior of being good) and ``kept``."""
    named = rules()
    names = list(named)
    voted = measured.withColumns({f"__{k}": v for k, v in named.items()})
    # At most 3^5 rows, counted on the executors. What fails the base rule is decided, and would make its own defects
    # the mark of a bad document.
    table = voted.where(~base_failed()).groupBy(*(f"__{k}" for k in names)).agg(F.count("*").alias("n")).collect()
    table.sort()
    model = estimate(np.array([r[:-1] for r in table], int).reshape(len(table), len(names)), np.array([r[-1] for r in table]))
    voted = voted.withColumns({"base_failed": base_failed(), "quality": posterior(model, names)})
    return voted.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep)).drop(*(f"__{k}" for k in names))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Measured once; a row of a few numbers per document.
    return judge(stored(measures(read(spark, sf_dir, "documents")), "measures"))


