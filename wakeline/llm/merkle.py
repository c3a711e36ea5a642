"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of paragraphs.

A paragraph is a line with its line end. A piece ends after a word whose hash is a multiple of ``PIECE_WORDS``, a section
after a paragraph whose hash is a multiple of ``SECTION_PARAGRAPHS``: bounds depend on content, so an
insertion moves none of the others. A node's digest (128 bits of BLAKE2) is that of its children's digests. The
fingerprint is the root's digest and, in base64, all nodes from the sections down, 48 bits of the digest each, with
their number of children (pieces: code points). Equality is told by the root alone, which is made of whole digests;
likeness goes by the short ones. ``differences`` goes down only where two trees differ and says where.

``likeness`` is the share of code points in pieces that both have (twice the common ones over the sum, copies
counted), 0 to 1.

The next document of each is found in one shuffle: documents are dealt out by id ranges, each range gets a
copy of the document just below it, and a task reads its range in order.

Defined cases: a null text is empty; the tree of an empty text has no nodes, and two empty texts are alike (1.0);
documents with one id are ordered by text; null ids come before all others; where no document has an id, the
first of the order has an empty next one; a single document is its own next; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import bounds, by_batch, longs, parts, read, record
from wakeline.llm.words import hashes, raw, slices, words

PIECE_WORDS = 8
SECTION_PARAGRAPHS = 8
#: Bytes of a node's digest.
DIGEST = 16
_NODE = np.dtype([("hash", "u1", 6), ("size", "<u4")])


def digests(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``DIGEST`` bytes for each range between successive bounds."""
    view, at = memoryview(np.ascontiguousarray(data).reshape(-1)), bounds.tolist()
    whole = b"".join([hashlib.blake2b(view[a:b], digest_size=DIGEST).digest() for a, b in zip(at, at[1:])])
    return np.frombuffer(whole, np.uint8).reshape(-1, DIGEST)


class Trees:
    """The trees of a batch of texts, level by level: hashes, sizes, and where each text's nodes begin."""

    def __init__(self, column: pa.Array):
        data, offsets = raw(column)
        starts, ends, _ = words(data, offsets)
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        self.chars = lead[offsets[1:]] - lead[offsets[:-1]]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        lines = np.flatnonzero(data == 10) + 1
        cut[lines] = True
        paragraph = cut.copy()
        cut[ends[hashes(data, starts, ends) % np.uint64(PIECE_WORDS) == 0]] = True
        at = np.flatnonzero(cut)
        leaves = digests(data, at)
        self.leaves = (leaves, (lead[at[1:]] - lead[at[:-1]]).astype(np.int64), np.searchsorted(at, offsets))
        first = np.flatnonzero(paragraph[at])  # of each paragraph its first piece, and the end
        paragraphs = digests(leaves, DIGEST * first)
        of_text = np.searchsorted(at[first], offsets)
        self.paragraphs = (paragraphs, np.diff(first), of_text)
        ends_section = np.zeros(len(paragraphs) + 1, bool)
        ends_section[1:] = paragraphs[:, -1] % SECTION_PARAGRAPHS == 0
        ends_section[of_text] = True
        first = np.flatnonzero(ends_section)
        sections = digests(paragraphs, DIGEST * first)
        self.sections = (sections, np.diff(first), np.searchsorted(first, of_text))

    def __len__(self) -> int:
        return len(self.chars)

    def pieces(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """48 bits of the digest and the code points of text ``i``'s pieces."""
        values, sizes, first = self.leaves
        a, b = first[i], first[i + 1]
        wide = np.zeros((b - a, 8), np.uint8)
        wide[:, :6] = values[a:b, :6]
        return wide.reshape(-1).view("<u8").astype(np.uint64), sizes[a:b]

    def fingerprint(self, i: int) -> str:
        levels = []
        for values, sizes, first in (self.sections, self.paragraphs, self.leaves):
            a, b = first[i], first[i + 1]
            node = np.zeros(b - a, _NODE)
            node["hash"] = values[a:b, :6]
            node["size"] = sizes[a:b]
            levels.append(node)
        values, _, first = self.sections
        own = values[first[i] : first[i + 1]].tobytes() + int(self.chars[i]).to_bytes(8, "little")
        root = hashlib.blake2b(own, digest_size=DIGEST).hexdigest()
        return f"{root}.{'.'.join(base64.b64encode(x.tobytes()).decode() for x in levels)}"


def decode(fingerprint: str) -> tuple[str, list[tuple[np.ndarray, np.ndarray]]]:
    root, *levels = fingerprint.split(".")
    out = []
    for level in levels:
        node = np.frombuffer(base64.b64decode(level), _NODE)
        wide = np.zeros((len(node), 8), np.uint8)
        wide[:, :6] = node["hash"]
        out.append((wide.reshape(-1).view("<u8").astype(np.uint64), node["size"].astype(np.int64)))
    return root, out


def common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Twice the code points of common pieces over all code points."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    both = np.concatenate((a[0], b[0]))
    keys, first, code = np.unique(both, return_index=True, return_inverse=True)
    n = len(a[0])
    shared = np.minimum(np.bincount(code[:n], minlength=len(keys)), np.bincount(code[n:], minlength=len(keys)))
    sizes = np.concatenate((a[1], b[1]))[first]
    return min(1.0, 2.0 * int((shared * sizes).sum()) / total)


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints."""
    if a.split(".", 1)[0] == b.split(".", 1)[0]:
        return 1.0
    return common(decode(a)[1][2], decode(b)[1][2])


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """Code point spans of the first text whose pieces the second has not, in order, adjoining ones joined.

    Subtrees that the second text has are passed over without a look at their children.
    """
    (root, tree), (other_root, other) = decode(a), decode(b)
    if root == other_root:
        return []
    known = [set(level[0].tolist()) for level in other]
    spans: list[tuple[int, int]] = []
    children = [np.concatenate(([0], np.cumsum(tree[k][1]))) for k in range(2)]
    place = np.concatenate(([0], np.cumsum(tree[2][1])))

    def visit(level: int, i: int) -> None:
        if int(tree[level][0][i]) in known[level]:
            return
        if level < 2:
            for j in range(children[level][i], children[level][i + 1]):
                visit(level + 1, int(j))
        elif spans and spans[-1][1] == place[i]:
            spans[-1] = (spans[-1][0], int(place[i + 1]))
        else:
            spans.append((int(place[i]), int(place[i + 1])))

    for i in range(len(tree[0][0])):
        visit(0, i)
    return spans


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every document; no shuffle."""
    data = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        text = batch.column("text")
        for i, j in slices(text):
            trees = Trees(text.slice(i, j - i))
            yield {
                "doc_id": batch.column("doc_id").slice(i, j - i),
                "n_chars": trees.chars,
                "fingerprint": [trees.fingerprint(k) for k in range(len(trees))],
            }

    return by_batch(data, "doc_id long, n_chars long, fingerprint string", work)


def with_next(docs: DataFrame, schema: str, work) -> DataFrame:
    """``work(ids, texts, before)`` on runs of documents in ascending order of (id, text).

    ``before`` is the text of the document before the run's first; before the very first comes the last.
    """
    spark = docs.sparkSession
    n = parts(spark)
    cuts = bounds(docs, "doc_id", n)
    last = docs.agg(F.max("doc_id")).first()[0]
    ends = np.array(cuts, np.int64)

    def numbered(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column("doc_id")
        part = np.searchsorted(ends, longs(ids, -(1 << 63)))
        yield {"part": part.astype(np.int32), "doc_id": ids, "text": batch.column("text"), "own": np.ones(len(part), bool)}

    def copies(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column("doc_id")
        at = np.searchsorted(ends, longs(ids))
        # The last document of a range goes to the next range, the last of all to the first.
        for part, here in ((at + 1, np.isin(longs(ids), ends)), (np.zeros_like(at), longs(ids) == last)):
            if here.any():
                chosen = pa.array(here)
                yield {
                    "part": part[here].astype(np.int32),
                    "doc_id": ids.filter(chosen),
                    "text": batch.column("text").filter(chosen),
                    "own": np.zeros(int(here.sum()), bool),
                }

    columns = "part int, doc_id long, text string, own boolean"
    data = by_batch(docs, columns, numbered)
    if last is not None:
        data = data.union(by_batch(docs.where(F.col("doc_id").isin(sorted({*cuts, last}))), columns, copies))
    data = data.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("own", "doc_id", "text")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = ""
        for batch in batches:
            for i, j in slices(batch.column("text")):
                texts = [x or "" for x in batch.column("text").slice(i, j - i).to_pylist()]
                own = batch.column("own").slice(i, j - i).to_numpy(zero_copy_only=False)
                ids = batch.column("doc_id").slice(i, j - i)
                skip = int((~own).sum())  # copies come first
                if skip:
                    before = texts[skip - 1]
                if skip < len(texts):
                    yield record(work(ids.slice(skip), texts[skip:], before), arrow)
                    before = texts[-1]

    return data.mapInArrow(run, schema)


def compared(ids: pa.Array, texts: list[str], before: str) -> dict:
    """The digest of a run: each text, its edited form and the next document, which is the one before in this order."""
    nexts = [before, *texts[:-1]]
    third = [len(t) // 3 for t in texts]
    edited = [t[: len(t) - k] + x[:k] for t, x, k in zip(texts, nexts, third)]
    trees, changed = Trees(pa.array([before, *texts])), Trees(pa.array(edited))
    prints = [trees.fingerprint(i) for i in range(1, len(trees))]
    other = [changed.fingerprint(i) for i in range(len(changed))]
    pieces = [trees.pieces(i) for i in range(len(trees))]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": prints,
        "edited_fingerprint": other,
        "near_edited": [common(pieces[i + 1], changed.pieces(i)) for i in range(len(texts))],
        "near_next": [common(pieces[i + 1], pieces[i]) for i in range(len(texts))],
    }


def op10_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_next(docs, SCHEMA, compared)
