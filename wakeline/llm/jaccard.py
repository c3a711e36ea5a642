"""Documents linked by the Jaccard similarity of their word shingles, by prefixes under several token orders.

Two sets with similarity ``t`` share a token among the first ``n - ceil(t n) + 1`` of each under *any* global order
of tokens. So candidates must share prefix tokens under every one of ``ORDERS`` orders (one brings them together, the
others must show as many common tokens as the similarity asks of prefixes); only pairs that pass all of these
filters are verified, exactly. All orders put frequent tokens last (``frequent``; what it finds only shapes the
orders, not the result) and differ in the hash that breaks ties. Where the first common token of two sets stands at places i and j of the order, they have at most
``min(n_a - i, n_b - j)`` tokens in common; pairs for which that is too few are not formed in that token's group.

Only what the result needs is compared: it is connected components, so in each group of documents that share a
prefix token a few pivots are compared with the others; then pivots leave, groups whose members are already connected
are done, and the rest goes on with more pivots. Pivots are those with the fewest rarer tokens of their own: of a text
and its edited copies the text itself. Each unordered pair in a group is either compared once or skipped
because both are connected by then or have too little left, so no link that matters is lost, and groups of copies cost rows in
proportion to their size. Equal sets are one node. Groups are streamed in sorted order with a few pivots in memory.

Defined cases: text without words has an empty set, linked with nothing; fewer words than a shingle are one
shingle; equal sets are linked whatever their ids; a component's id is its smallest document id, null if it has none; an
empty table gives an empty one; other columns are ignored (``one_of_each`` keeps them). Shingles are 52-bit
hashes (so that a sort of plain integers orders a batch of texts), names of sets 64-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, parts, ragged, read, remove, stored, union_labels
from wakeline.llm.words import fold, grams, hashes, mix, owners, ranges, raw, slices, words

SHINGLE = 5
PERCENT = 80
ORDERS = 3
#: Hashed levels of frequent tokens, how many such tokens make them up at most, and tokens that a task counts at once.
BUCKETS, FREQUENT, COUNTED = 1 << 24, 1 << 20, 1 << 21
#: Bits a name of the filter that goes before a semi-join, and all its bits at most; beyond them it lets more through.
BITS, MOST_BITS = 8, 1 << 27
#: Pivots of a group in the first round; eight times as many in each further one, as what is still open then is unlike.
PIVOTS = 2
#: Bits of a shingle, texts of a batch (their number takes the other bits), bits of a token in an order.
WIDTH, TEXTS, TOKEN = 52, 1 << 12, 46
_SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def sets_of(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin; at most ``TEXTS`` texts."""
    data, offsets = raw(column)
    data = fold(data)
    starts, ends, first = words(data, offsets)
    hashed = hashes(data, starts, ends)
    count = np.diff(first)
    whole = grams(hashed, size)
    enough = np.maximum(count - size + 1, 0)
    out = [whole[ranges(first[:-1], enough)]]
    text = [np.repeat(np.arange(len(count)), enough)]
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            out.append(grams(hashed, n, seed=n)[first[:-1][short]])
            text.append(short)
    values, text = np.concatenate(out), np.concatenate(text)
    key = np.sort((text.astype(np.uint64) << np.uint64(WIDTH)) | (values >> np.uint64(64 - WIDTH)))
    key = key[np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))]
    # The end of text 4095 would not fit in 64 bits, so the last bound is the number of keys.
    begins = np.append(np.searchsorted(key, np.arange(len(count), dtype=np.uint64) << np.uint64(WIDTH)), len(key))
    return key & np.uint64((1 << WIDTH) - 1), begins


def nodes_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A name for each set: a hash of its shingles in order."""
    names = hashes(np.ascontiguousarray(values).view(np.uint8), 8 * first[:-1], 8 * first[1:])
    return mix(names + np.diff(first).astype(np.uint64)).view(np.int64)


def bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(WIDTH - BUCKETS.bit_length() + 1)).astype(np.int64)


def prefix(values: np.ndarray, first: np.ndarray, level: np.ndarray, order: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each set's prefix under an order, and where they begin. A token is the shingle's place in the order."""
    n = np.diff(first)
    token = mix(values ^ _SEEDS[order]) >> np.uint64(64 - TOKEN)
    key = (owners(first).astype(np.uint64) << np.uint64(WIDTH)) | (level[bucket(values)].astype(np.uint64) << np.uint64(TOKEN)) | token
    key.sort()
    length = n - (percent * n + 99) // 100 + (n > 0)
    return key[ranges(first[:-1], length)] & np.uint64((1 << TOKEN) - 1), np.concatenate(([0], np.cumsum(length)))


def coinciding(tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Of each prefix, how many tokens have a lower half that another one before has."""
    key = np.sort((owners(begins).astype(np.uint64) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF)))
    again = (key[1:][key[1:] == key[:-1]] >> np.uint64(32)).astype(np.int64)
    return np.bincount(again, minlength=len(begins) - 1)


class _Seen:
    """Names met by a task, so that copies it meets again are not sent again; forgetting only costs repeats."""

    def __init__(self, most: int = 500_000):
        self.names: set[int] = set()
        self.most = most

    def new(self, names: np.ndarray) -> np.ndarray:
        if len(self.names) > self.most:
            self.names.clear()
        out = np.zeros(len(names), bool)
        for i, x in enumerate(names.tolist()):
            if x not in self.names:
                self.names.add(x)
                out[i] = True
        return out


def _texts(docs: DataFrame, schema: str, work) -> DataFrame:
    """``work(values, first, nodes)`` on the distinct non-empty sets that a batch brings."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from wakeline.llm.common import record, release

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, state = _Seen(), {}
        for batch in batches:
            column = batch.column("text")
            for i, j in slices(column, 1 << 20, TEXTS):
                values, first = sets_of(column.slice(i, j - i))
                names = nodes_of(values, first)
                keep = seen.new(names) & (np.diff(first) > 0)
                at, n = first[:-1][keep], np.diff(first)[keep]
                values, first = values[ranges(at, n)], np.concatenate(([0], np.cumsum(n)))
                out = work(values, first, names[keep], state)
                if out is not None:
                    yield record(out, arrow)
        out = work(None, None, None, state)
        if out is not None:
            yield record(out, arrow)
        seen.names.clear()
        state.clear()
        release()

    return docs.select("text").mapInArrow(run, schema)


def frequent(docs: DataFrame) -> np.ndarray:
    """Level of each bucket: 0, or more for buckets with a token that many sets have.

    Tasks report tokens that two of some ten thousand neighbouring sets share, Spark adds them up, and the most frequent
    ones count, as many powers of two as ``FREQUENT`` tokens cover. Other tokens of a bucket are taken for frequent too.
    """

    def work(values, first, names, state):
        held = state.setdefault("held", [])
        if values is not None:
            held.append(values)
            state["n"] = state.get("n", 0) + len(values)
        if not held or (values is not None and state["n"] < COUNTED):
            return None
        token, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        state["n"] = 0
        return {"token": token[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)}

    level = F.floor(F.log2("n")).cast("int")
    found = _texts(docs, "token long, n long", work).groupBy("token").agg(F.sum("n").alias("n")).where("n > 7")
    found = stored(found.select("token", level.alias("level")), "frequent")
    counts = {r["level"]: r["n"] for r in found.groupBy("level").agg(F.count("*").alias("n")).collect()}
    least, total = 64, 0
    for x in sorted(counts, reverse=True):
        total += counts[x]
        if total > FREQUENT:
            break
        least = x
    rows = found.where(F.col("level") >= least).toArrow()
    remove(found)
    out = np.zeros(BUCKETS, np.uint8)
    np.maximum.at(out, bucket(rows.column("token").to_numpy().view(np.uint64)), rows.column("level").to_numpy().astype(np.uint8))
    return out


def pairs_in_groups(rows: DataFrame, pivots: int, percent: int = PERCENT) -> DataFrame:
    """Of rows (token, node, at, comp): pairs (kind 0, a, b) of each group's pivots with its other members, where
    what is left of both sets allows the similarity and components differ, and the group without pivots (kind 1).

    ``at`` has the token's place in its upper half and the size of the set in the lower one. Without ``comp``
    every node is its own component.
    """
    columns = [c for c in ("token", "node", "at", "comp") if c in rows.columns]
    dealt = rows.select(*columns).repartition(parts(rows.sparkSession), "token").sortWithinPartitions("token", "at", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = np.zeros((len(columns), 0), np.int64)  # the pivots of the group that is open
        for batch in batches:
            fresh = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            if carry.shape[1] and carry[0, 0] != fresh[0, 0]:
                carry = carry[:, :0]
            both = np.concatenate((carry, fresh), axis=1)
            twice = np.zeros(both.shape[1], bool)
            twice[1:] = (both[0, 1:] == both[0, :-1]) & (both[1, 1:] == both[1, :-1])
            own = np.arange(both.shape[1]) >= carry.shape[1]
            both, own = both[:, ~twice], own[~twice]
            token, node, at = both[:3]
            comp = both[3] if len(both) > 3 else node
            n = at & 0xFFFFFFFF
            left = n - (at >> 32)
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            begins = np.flatnonzero(new)
            begin = begins[np.cumsum(new) - 1]
            place = np.arange(len(token)) - begin
            found = []
            for j in range(min(pivots, int(place.max(initial=0)))):
                x = np.flatnonzero((place > j) & own)
                y = begin[x] + j
                ok = (comp[x] != comp[y]) & ((100 + percent) * np.minimum(left[x], left[y]) >= percent * (n[x] + n[y]))
                found.append(np.stack((np.minimum(node[x[ok]], node[y[ok]]), np.maximum(node[x[ok]], node[y[ok]]))))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
            rest = (place >= pivots) & own
            k, m = pairs.shape[1], int(rest.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([0, 1], [k, m]), pa.int32()),
                    pa.array(np.concatenate((pairs[0], node[rest]))),
                    pa.array(np.concatenate((pairs[1], token[rest]))),
                    pa.array(np.concatenate((np.zeros(k, np.int64), at[rest]))),
                ],
                ["kind", "a", "b", "at"],
            )
            last = begins[-1]
            carry = both[:, last : last + pivots]

    return dealt.mapInArrow(run, "kind int, a long, b long, at long")


def filter_of(nodes: DataFrame) -> np.ndarray:
    """A bit per hashed name, in words of 32; what else has its bit set only makes work for the semi-join behind it."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(16, (BITS * nodes.count()).bit_length()))
    at = nodes.select(F.col("node").bitwiseAND(bits - 1).alias("x"))
    found = at.groupBy(F.shiftright("x", 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1, cast(x & 31 as int))")).alias("bits"))
    rows = found.toArrow()  # 8 bytes for every 32 bits, so 32 MB at most
    out = np.zeros(bits // 32, np.int32)
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint32)


def links(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """(node, label): components of named sets, for sets that are linked to another."""
    spark = docs.sparkSession
    level = frequent(docs)
    heavy = np.flatnonzero(level)
    heavy = (heavy.astype(np.int32), level[heavy])

    def levels(state) -> np.ndarray:
        if "level" not in state:
            state["level"] = np.zeros(BUCKETS, np.uint8)
            state["level"][heavy[0]] = heavy[1]
        return state["level"]

    def posting(values, first, names, state):
        if values is None:
            return None
        tokens, begins = prefix(values, first, levels(state), 0, percent)
        count = np.diff(begins)
        place = np.arange(len(tokens)) - np.repeat(begins[:-1], count)
        return {"token": tokens.view(np.int64), "node": np.repeat(names, count), "at": place << 32 | np.repeat(np.diff(first), count)}

    rows = _texts(docs, "token long, node long, at long", posting)
    names = [f"p{k}" for k in range(1, orders)]

    def sets_for(nodes: DataFrame, prefixes: bool, whole: bool) -> DataFrame:
        """The named sets, their prefixes or whole, stored; made anew from the texts, as most are never asked for."""
        nodes = stored(nodes.distinct(), "asked")
        bits = filter_of(nodes)

        def work(values, first, names_, state):
            if values is None:
                return None
            at = names_ & (32 * len(bits) - 1)
            keep = (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            n = np.diff(first)[keep]
            values, first = values[ranges(first[:-1][keep], n)], np.concatenate(([0], np.cumsum(n)))
            out = {"node": names_[keep], "n": n}
            if whole:
                out["whole"] = ragged(values.view(np.int64), first, pa.int64())
            for k in range(1, orders) if prefixes else ():
                tokens, begins = prefix(values, first, levels(state), k, percent)
                # Half of a token will do to rule a pair out, with as much allowed for as halves of the prefix coincide.
                out[f"p{k}"] = ragged(tokens.view(np.int64).astype(np.int32), begins, pa.int32())
                out[f"alike_p{k}"] = coinciding(tokens, begins)
            return out

        columns = ["whole array<long>"] * whole + [f"{p} array<int>, alike_{p} long" for p in names if prefixes]
        passed = _texts(docs, ", ".join(["node long", "n long", *columns]), work).join(nodes, "node", "left_semi")
        table = stored(passed.dropDuplicates(["node"]), "sets")
        remove(nodes)
        return table

    def joined(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
        sets = sets.select("node", "n", *columns)
        for s in ("b", "a"):
            pairs = pairs.join(sets.select(*(F.col(c).alias(s if c == "node" else f"{c}_{s}") for c in sets.columns)), s)
        return pairs

    def filtered(pairs: DataFrame) -> DataFrame:
        """Pairs that share as many prefix tokens under every order as the similarity asks for.

        Of the ``least`` common tokens, those not in both prefixes are in the rest of the set whose prefix
        ends first in the order, so at most as many as the longer rest has are missing. Common tokens whose halves coincide
        count once; no more are lost by that than coincide in either prefix.
        """
        least = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
        for p in names:
            rest = F.greatest(*(F.col(f"n_{s}") - F.size(f"{p}_{s}") for s in ("a", "b")))
            shared = F.size(F.array_intersect(f"{p}_a", f"{p}_b"))
            alike = F.least(f"alike_{p}_a", f"alike_{p}_b")
            pairs = pairs.where(shared >= F.greatest(least - rest - alike, F.lit(1).cast("long")))
        return pairs.select("a", "b")

    pivots, sets, edges, whole = PIVOTS, None, None, None
    short = [c for p in names for c in (p, f"alike_{p}")]
    found = stored(pairs_in_groups(rows, pivots, percent), "pairs")
    while True:
        pairs = stored(found.where("kind = 0").select("a", "b").distinct(), "candidates")
        if sets is None:
            sets = sets_for(pairs.select(F.explode(F.array("a", "b")).alias("node")), True, False)
        passed = stored(filtered(joined(pairs, sets, short)), "passed")
        remove(pairs)
        if whole is None:
            whole = sets_for(passed.select(F.explode(F.array("a", "b")).alias("node")), False, True)
        verified = joined(passed, whole, ["whole"])
        verified = verified.withColumn("i", F.size(F.array_intersect("whole_a", "whole_b")))
        verified = verified.where(100 * F.col("i") >= percent * (F.col("n_a") + F.col("n_b") - F.col("i"))).select("a", "b")
        # A few edges that span each component stand for all links so far.
        new = verified if edges is None else verified.union(edges.select(F.col("node").alias("a"), F.col("label").alias("b")))
        before, edges = edges, stored(union_labels(new), "labels")
        remove(passed, before)
        if whole is not sets:
            remove(whole)
            whole = None
        left = found.where("kind = 1").select(F.col("b").alias("token"), F.col("a").alias("node"), "at")
        left = left.join(edges.select("node", F.col("label").alias("comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        left = left.select("token", "node", "at", "comp")
        size, place = F.col("at").bitwiseAND(0xFFFFFFFF), F.shiftright("at", 32)
        open_ = left.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.min(size).alias("least")).where("x < y")
        # Rows with too little left even for the smallest set of the group are done there.
        left = left.join(open_.select("token", "least"), "token").where((100 + percent) * (size - place) >= percent * (size + F.col("least")))
        before, rows = found, stored(left.drop("least"), "groups")
        remove(before)
        if rows.isEmpty():
            remove(sets, rows)
            return edges
        if pivots <= 8 * PIVOTS:
            # All that later rounds can ask for is in the groups that are open now; in the end that is little.
            remove(sets)
            sets = sets_for(rows.select("node"), True, pivots > PIVOTS)
            whole = sets if pivots > PIVOTS else None
        pivots *= 8
        found = stored(pairs_in_groups(rows, pivots, percent), "pairs")
        remove(rows)


def components(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, print, n_shingles, label, component_id) of every row.

    ``print`` is a hash of the text, ``label`` names the component, and is null for an empty set.
    """
    text = F.col(text_column).cast("string")
    data = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column("text")
        for i, j in slices(column, 1 << 20, TEXTS):
            values, first = sets_of(column.slice(i, j - i))
            n = np.diff(first)
            node = pa.array(nodes_of(values, first), mask=n == 0)
            yield {c: batch.column(c).slice(i, j - i) for c in ("doc_id", "print")} | {"n_shingles": n, "node": node}

    rows = stored(by_batch(data, "doc_id long, print long, n_shingles long, node long", work), "nodes")
    labels = links(data, percent)
    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    least = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # One row per distinct set; those without a link are their own component.
    low = least.groupBy("label").agg(F.min("low").alias("component_id"))
    named = least.join(low, "label").select("node", "label", F.col("component_id").alias("__component"))
    return rows.join(named, "node", "left").select(
        "doc_id",
        "print",
        "n_shingles",
        "label",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("__component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, then hash of its text.

    A null id counts as the greatest. Rows without words all stay.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # a column of docs may have any name
    own_id, own_text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    plain = docs.toDF(*names)
    key = F.coalesce(F.col(own_id).cast("long"), F.lit((1 << 63) - 1))
    found = components(docs, percent).where("label is not null")
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("key_"), F.col("print").alias("print_"))
    first = found.groupBy("label").agg(F.min(place).alias("m")).select("m.*")
    has_words = F.coalesce(F.col(own_text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = plain.where(has_words).withColumns({"key": key, "print": F.xxhash64(own_text)})
    # Rows alike in id and text are one component: one of them stays.
    one = rows.join(first, (F.col("key") == F.col("key_")) & (F.col("print") == F.col("print_"))).dropDuplicates(["key", "print"])
    kept = one.select(*names).union(plain.where(~has_words))
    return kept.toDF(*docs.columns)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
