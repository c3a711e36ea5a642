"""Language of texts that may switch languages, by a linear-chain conditional random field over words.

A word's features are its affixes, its character n-grams and whether a lexicon of common words has it; the
languages and the transitions between neighbours' languages are learned together by maximum likelihood, with
forward-backward giving the expected counts. Every word of a text is then labelled by forward-backward, and the text's
language is the one with the greatest sum of marginal probabilities over its letters; that share is the score.

Words are runs of letters, lower-cased. A chain is a stretch of text between sentence ends, at most ``CHAIN``
words long; longer stretches are several chains.

Learning uses a bounded sample: ``SAMPLE`` labelled documents, shared out evenly among the languages (one each at
least) and chosen by a hash of the id, and of each
document at most ``CHAINS_EACH`` chains, spread over all of it. The lexicon (words that occur in at least two sampled
documents, where nine in ten of their uses are in one language) comes from the same sample. The model is a few
arrays of fixed size, sent to the tasks as such. Prediction reads whole texts and nothing but the text.

Emission scores of a word depend on the word alone, so that a worker computes them once per distinct word (bounded
cache).

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the language first in
alphabetical order; repeated rows are labelled alike; without a labelled document every text is ``und``; an empty
table gives an empty one; extra columns are kept, save those named like
the two results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, read, release
from wakeline.llm.words import raw, slices

CHAIN = 64
#: Labelled documents learned from, and chains of each.
SAMPLE = 1200
CHAINS_EACH = 12
ROUNDS = 30
BUCKETS = 1 << 15
#: Words times languages worked on at once in learning, which the driver does: some ten arrays of so many doubles.
CELLS = 1 << 18
DECAY = 1e-5
CACHE = 250_000
UNKNOWN = "und"
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".!?;:\n"]] = True
#: ASCII that is not a letter separates words; bytes of other characters stay in, and are sorted out per distinct word.
_APART = np.ones(256, bool)
_APART[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Buckets of a word's features: affixes, the whole word, all n-grams with edges, the lexicon."""
    edged = f"<{word}>"
    found = [f"p{word[:k]}" for k in (1, 2, 3)] + [f"s{word[-k:]}" for k in (1, 2, 3, 4)] + [f"w{word}"]
    found.append(f"l{lexicon.get(word, -1)}")
    found += [f"g{edged[i : i + 3]}" for i in range(len(edged) - 2)]
    return [zlib.crc32(f.encode()) % BUCKETS for f in found]


def table(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words, one after the other, and where each word's begin; no word is without."""
    rows = [features(w, lexicon) for w in words]
    count = np.array([len(r) for r in rows], np.int64)
    return np.array([b for r in rows for b in r], np.int64), np.cumsum(count) - count


def emissions(weights: np.ndarray, rows: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sum of the weights of each word's features: (word, language)."""
    flat, begins = rows
    return np.add.reduceat(weights[flat], begins, axis=0) if len(begins) else np.zeros((0, weights.shape[1]))


def letters(word: str) -> str:
    """The word's letters in lower case."""
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()


def chains_of(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of a batch, the text each belongs to, and where chains start."""
    data, offsets = raw(column)
    inside = ~_APART[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1] | cut[1:-1]
    starts = np.flatnonzero(first)
    place = np.concatenate(([0], np.cumsum(inside)))
    pieces = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(place[starts], place[-1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[inside]))
    ).dictionary_encode()
    text = np.searchsorted(offsets, starts, "right") - 1
    edges = np.concatenate(([0], np.cumsum(_EDGE[data])))
    new = np.ones(len(starts), bool)
    if len(starts) > 1:
        new[1:] = (edges[starts[1:]] > edges[starts[:-1]]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(new)
    if len(begins):
        # Cut long stretches every CHAIN words.
        since = np.arange(len(starts)) - np.repeat(begins, np.diff(np.append(begins, len(starts))))
        new |= since % CHAIN == 0
    return pieces, text, np.flatnonzero(new)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray):
    """Marginals (chain, word, language), expected moves, and log-likelihood's normaliser of each chain.

    ``scores``: (chain, word, language), chains sorted by falling length.
    """
    n, longest, k = scores.shape
    top = scores.max(axis=2, keepdims=True)
    emit = np.exp(scores - top)
    move, begin = np.exp(moves), np.exp(start)
    ahead, behind = np.zeros_like(emit), np.ones_like(emit)
    scale = np.ones((n, longest))
    alive = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # chains with more than t words
    for t in range(longest):
        m = alive[t]
        a = (begin if t == 0 else ahead[:m, t - 1] @ move) * emit[:m, t]
        scale[:m, t] = a.sum(axis=1)
        ahead[:m, t] = a / scale[:m, t, None]
    for t in range(longest - 2, -1, -1):
        m = alive[t + 1]
        behind[:m, t] = (behind[:m, t + 1] * emit[:m, t + 1]) @ move.T / scale[:m, t + 1, None]
    mask = np.arange(longest) < lengths[:, None]
    marginal = ahead * behind * mask[:, :, None]
    later = behind[:, 1:] * emit[:, 1:] / scale[:, 1:, None] * mask[:, 1:, None]
    expected = np.einsum("nti,ntj->ij", ahead[:, :-1], later) * move
    return marginal, expected, (np.log(scale) + top[:, :, 0]).sum(axis=1, where=mask)


def blocks(starts: np.ndarray, lengths: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chains of falling length, some at a time: their lengths and their words' places as (chain, word).

    A block has at most ``most`` places, or one chain.
    """
    order = np.argsort(-lengths, kind="stable")
    while len(order):
        longest = max(1, int(lengths[order[0]]))
        some, order = np.split(order, [max(1, most // longest)])
        yield lengths[some], starts[some][:, None] + np.arange(longest)


class Model:
    """Languages, lexicon, feature weights (bucket, language), start and transition weights."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((BUCKETS, k))
        self.start, self.moves = np.zeros(k), np.zeros((k, k))

    def fit(self, words: list[str], code: np.ndarray, starts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> None:
        """Maximum likelihood by Adam over all chains. ``code`` indexes words, ``labels`` are languages of chains."""
        rows = table(words, self.lexicon)
        count = np.diff(np.append(rows[1], len(rows[0])))
        lengths = np.diff(np.append(starts, len(code)))
        k = len(self.languages)
        total = float(lengths.sum())
        seen = np.zeros((len(words), k))
        np.add.at(seen, (code, np.repeat(labels, lengths)), 1)
        parameters = [self.weights, self.start, self.moves]
        first = [np.zeros_like(p) for p in parameters]
        second = [np.zeros_like(p) for p in parameters]
        stay = np.bincount(labels, np.maximum(lengths - 1, 0), k)
        for step in range(1, rounds + 1):
            emission = emissions(self.weights, rows)
            flat, begun, expected = np.zeros((len(words), k)), np.zeros(k), np.zeros((k, k))
            for size, at in blocks(starts, lengths, CELLS // k):
                at, mask = code[np.minimum(at, len(code) - 1)], np.arange(at.shape[1]) < size[:, None]
                marginal, moved, _ = forward_backward(emission[at], size, self.start, self.moves)
                for j in range(k):
                    flat[:, j] += np.bincount(at[mask], marginal[:, :, j][mask], len(words))
                begun += marginal[:, 0].sum(axis=0)
                expected += moved
            per_word = (seen - flat) / total
            slope = np.stack([np.bincount(rows[0], np.repeat(per_word[:, j], count), BUCKETS) for j in range(k)], axis=1)
            slope -= DECAY * self.weights
            slopes = [
                slope,
                (np.bincount(labels, minlength=k) - begun) / total,
                (np.diag(stay) - expected) / total - DECAY * self.moves,
            ]
            for p, s, a, b in zip(parameters, slopes, first, second):
                a += 0.1 * (s - a)
                b += 0.01 * (s * s - b)
                p += 0.15 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)

    def label(self, column: pa.Array, cache: dict) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the sum of marginals over letters, and the number of letters."""
        pieces, text, starts = chains_of(column)
        k = len(self.languages)
        sums = np.zeros((len(column), k))
        if not len(text):
            return sums, np.zeros(len(column))
        found = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = cache.setdefault("place", {})
        if len(place) > CACHE:
            place.clear()
        new = [w for w in found if w not in place]
        rows = cache.setdefault("rows", np.zeros((0, k + 1)))
        if len(place) + len(new) > len(rows):
            rows = cache["rows"] = np.concatenate((rows, np.zeros((len(new) + len(rows), k + 1))))
        at = len(place) + np.arange(len(new))
        plain = [letters(w) for w in new]
        count = np.array([len(p) for p in plain], np.float64)
        rows[at, :k] = emissions(self.weights, table(plain, self.lexicon)) * (count > 0)[:, None]
        rows[at, k] = count
        place.update(zip(new, at.tolist()))
        known = rows[np.array([place[w] for w in found])][pieces.indices.to_numpy()]
        lengths = np.diff(np.append(starts, len(text)))
        # Chains of like length go together, so that little is padded.
        order = np.argsort(-lengths, kind="stable")
        for a in range(0, len(order), 4096):
            some = order[a : a + 4096]
            size = lengths[some]
            at = np.minimum(starts[some][:, None] + np.arange(size[0]), len(text) - 1)
            marginal, _, _ = forward_backward(known[at, :k], size, self.start, self.moves)
            mask = np.arange(size[0]) < size[:, None]
            weight = known[at, k] * mask
            of = np.repeat(text[starts[some]], size)
            for j in range(k):
                sums[:, j] += np.bincount(of, (marginal[:, :, j] * weight)[mask], len(column))
        return sums, np.bincount(text, known[:, k], len(column))


def is_held_out(id_column: str | Column) -> Column:
    """Documents never learned from: crc32 of the id as text is a multiple of five."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, each: int = CHAINS_EACH) -> Model:
    """A model of the non-null languages of ``docs`` (doc_id, text, lang), from a bounded sample."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = F.xxhash64(F.lit("language"), "doc_id")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], {})
    share = max(1, sample // len(languages))
    # A language's rows whose hash, as a number from 0 to 1, is below this are some more than its share; the smallest of them count.
    least = F.lit(0.0)
    for lang, n in counts.items():
        least = F.when(F.col("lang") == lang, F.lit(1.0 if n <= 4 * share else (share + 8 * share**0.5) / n)).otherwise(least)

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        """Of each text up to ``each`` chains, spread over all of it."""
        for i in range(batch.num_rows):
            pieces, _, starts = chains_of(batch.column("text").slice(i, 1))
            words = pieces.cast(pa.string()).to_pylist()
            ends = np.append(starts[1:], len(words))
            picked = range(len(starts)) if len(starts) <= each else np.linspace(0, len(starts) - 1, each).astype(int)
            rows = [" ".join(w for w in map(letters, words[starts[c] : ends[c]]) if w) for c in picked]
            yield {"lang": [batch.column("lang")[i].as_py()] * len(rows), "doc": [i] * len(rows), "chain": rows}

    some = known.where(F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53)) <= least).select("text", "lang", hashed.alias("r"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("r", "text"))
    rows = some.withColumn("place", order).where(F.col("place") <= share).drop("place", "r")
    found = [r for r in by_batch(rows, "lang string, doc long, chain string", cut).collect() if r["chain"]]
    found.sort()
    model = learned(found, languages)
    release()
    return model


def learned(chains: list, languages: list[str]) -> Model:
    """A model from (language, document, words joined by spaces)."""
    place = {lang: i for i, lang in enumerate(languages)}
    uses: dict[str, np.ndarray] = {}
    where: dict[str, set] = {}
    for lang, doc, chain in chains:
        for w in chain.split(" "):
            uses.setdefault(w, np.zeros(len(languages)))[place[lang]] += 1
            if len(where.setdefault(w, set())) < 2:
                where[w].add((lang, doc))
    lexicon = {w: int(u.argmax()) for w, u in uses.items() if len(where[w]) > 1 and u.max() >= 0.9 * u.sum()}
    model = Model(languages, lexicon)
    if not chains:
        return model
    words = sorted(uses)
    index = {w: i for i, w in enumerate(words)}
    lists = [[index[w] for w in chain.split(" ")] for _, _, chain in chains]
    lengths = np.array([len(x) for x in lists])
    model.fit(words, np.concatenate(lists), np.concatenate(([0], np.cumsum(lengths)[:-1])), np.array([place[c[0]] for c in chains]))
    return model


def predict(
    docs: DataFrame, model: Model, text_column: str = "text", keep_text: bool = False, out: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the language and the score in columns ``out``, without the text unless ``keep_text``."""
    kept = [c for c in docs.columns if c not in out and (keep_text or c != text_column)]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), f"`{out[0]}` string", f"`{out[1]}` double"])
    names = np.array([*model.languages, UNKNOWN], object)
    cache: dict = {}

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        text = batch.column(text_column)
        for i, j in slices(text):
            part = text.slice(i, j - i)
            if model.languages:
                sums, total = model.label(part, cache)
                best = np.where(total > 0, sums.argmax(axis=1), len(model.languages))
                score = np.where(total > 0, sums.max(axis=1) / np.maximum(total, 1), 0.0)
            else:
                best, score = np.zeros(j - i, int), np.zeros(j - i)
            columns = {c: batch.column(c).slice(i, j - i) for c in kept}
            yield columns | {out[0]: pa.array(names[best], pa.string()), out[1]: np.clip(score, 0.0, 1.0)}

    return by_batch(docs.select(*dict.fromkeys([*kept, text_column])), schema, work)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(docs.where(~is_held_out("doc_id")))
    return predict(docs.select("doc_id", is_held_out("doc_id").alias("held_out"), "text"), model)


def keep_known(docs: DataFrame, least: float = 0.4, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose text has a language at a score of ``least``; learned from their own ``lang``.

    Without any label there is nothing to reject a text by, and all stay.
    """
    model = learn(docs.where(~is_held_out(id_column)))
    if not model.languages:
        return docs
    name, score = (next(n for i in range(len(docs.columns) + 1) if (n := f"{base}_{i}") not in docs.columns) for base in ("lang", "share"))
    found = predict(docs, model, keep_text=True, out=(name, score))
    return found.where((F.col(name) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
