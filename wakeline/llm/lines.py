"""Line dedup: repeated runs of lines, whose later copies are deleted, by a suffix array over the documents' line ids.

The array is made by prefix doubling, one round of shuffles a level. At level k every place of the corpus where a run of 2^k
lines begins has the rank of that run among all of them: how many places come before it in the order of their first 2^k
lines. A level follows from the one before: the pair of ranks at a place and 2^(k-1) lines on is counted (map-side
first), pairs are put in order across the cluster, and each gets the number of places before it. Places of one rank are an
interval of the array whose common prefix has 2^k lines at least. Places whose run occurs nowhere else leave the array, as
no longer run from there can recur; so a level costs what is repeated at that length.

A run is repeated if it has a word and occurs before (in the order of document id, then line), and worth deleting if
it has ``least_words`` words too. Every such run, whatever its length, is the union of shortest runs of that many words that
start at one of its lines and of those that end at one. For these, two per line, one for one word and one for
``least_words``, the interval is that of two ranks which cover the run; levels go as high as the longest of them asks
for. The first place of an interval stays, the others are later copies. Adjoining
repeated or deleted lines make up one run.

Line ids have 128 bits (xxh3), ranks are exact. A rank with very many places (blank lines) is not dealt to one task: ranks with more
than a 4096th of all places, 4,096 at most, are broadcast.

Defined cases: null and empty texts have no lines and stay as they are; lines are compared byte by byte; blank lines
have no words; rows equal in id and text are one document, and each keeps what the other does; a null id comes first; an
empty table gives an empty one. Columns other than text and n_chars are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wakeline.llm.common import by_batch, free, parts, read, remove, stored
from wakeline.llm.words import owners, raw, slices, words

#: Words of a run that is deleted; shorter ones are found and counted only. The README has the figures behind it.
LEAST_WORDS = 15
#: Names with more than this share of all rows are few enough to be broadcast.
HOT = 1 << 12
DOC = ["doc_id", "print"]


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of \\n-separated lines, and the first line of each text; an empty text has none."""
    breaks = np.flatnonzero(data == 10)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    starts = np.sort(np.concatenate((offsets[filled], breaks + 1)))
    ends = np.sort(np.concatenate((offsets[filled + 1], breaks)))
    # A text that ends in a line break has an empty last line, which starts where the next text does.
    count = np.zeros(len(offsets) - 1, np.int64)
    count[filled] = 1
    count += np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    return starts, ends, np.concatenate(([0], np.cumsum(count)))


def shortest_runs(weight: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs within a text with ``least`` words: from each line the shortest one, and to each line the shortest one."""
    n = len(weight)
    total = np.concatenate(([0], np.cumsum(weight)))
    text = owners(first)
    begin, end = first[:-1][text], first[1:][text]
    at = np.arange(n)
    stop = np.searchsorted(total, total[:-1] + least)  # the first end with enough words
    forward = stop <= end
    start = np.searchsorted(total, total[1:] - least, "right") - 1  # the last start with enough words
    backward = (total[1:] >= least) & (start >= begin)
    a = np.concatenate((at[forward], start[backward]))
    b = np.concatenate((stop[forward], at[backward] + 1))
    pairs = np.unique(np.stack((a, b), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1] - pairs[:, 0]


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, print, line, a, b, words) of every line, ``a`` and ``b`` being its id."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        text = batch.column("text")
        for i, j in slices(text):
            data, offsets = raw(text.slice(i, j - i))
            at, end, first = lines(data, offsets)
            starts, _, _ = words(data, offsets)
            view = memoryview(np.ascontiguousarray(data))
            named = b"".join([xxhash.xxh3_128_digest(view[x:y]) for x, y in zip(at.tolist(), end.tolist())])
            names = np.frombuffer(named, "<i8").reshape(-1, 2)
            of = pa.array(owners(first))
            yield {
                **{c: batch.column(c).slice(i, j - i).take(of) for c in DOC},
                "line": (np.arange(len(at)) - first[:-1][owners(first)]).astype(np.int32),
                "a": names[:, 0],
                "b": names[:, 1],
                "words": (np.searchsorted(starts, end) - np.searchsorted(starts, at)).astype(np.int32),
            }

    return by_batch(docs, "doc_id long, print long, line int, a long, b long, words int", work)


def ranked(rows: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Rows whose pair (a, b) occurs again, with the pair's ``rank`` instead of it, stored; and how many they are.

    The rank is the number of such rows with a smaller pair.
    """
    names = stored(rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"), "names")
    dealt = names.repartitionByRange(parts(rows.sparkSession), "a", "b").sortWithinPartitions("a", "b")
    fields = ["a", "b", "n", "part", "before"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            upto = total + np.cumsum(n)
            columns = [*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(upto - n)]
            total = int(upto[-1]) if len(n) else total
            yield pa.RecordBatch.from_arrays(columns, fields)

    numbered = stored(dealt.mapInArrow(number, "a long, b long, n long, part int, before long"), "ranks")
    sums = sorted(map(tuple, numbered.groupBy("part").agg(F.sum("n")).collect()))  # a row a partition
    remove(names)
    start, begins = 0, {}
    for part, n in sums:
        begins[part] = start
        start += n
    offsets = F.create_map(*(F.lit(x) for pair in begins.items() for x in pair)) if begins else None
    rank = F.col("before") + (offsets[F.col("part")] if begins else F.lit(0))
    table = numbered.select(F.col("a").alias("a_"), F.col("b").alias("b_"), "n", rank.alias("rank"))
    kept = [c for c in rows.columns if c not in ("a", "b")]
    found = stored(joined(rows, table, ["a", "b"], total).select(*kept, "rank"), "places")
    remove(numbered)
    return found, start


def joined(rows: DataFrame, names: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``names`` (keys named ``<key>_``, and their number of rows ``n``).

    Of names with more than ``total`` / ``HOT`` rows there are ``HOT`` at most: they are broadcast.
    """
    many = max(64, total // HOT)
    same = [F.col(k) == F.col(f"{k}_") for k in keys]
    hot, rest = F.broadcast(names.where(F.col("n") > many)), names.where(F.col("n") <= many)
    cold = rows.join(hot, same, "left_anti")
    return rows.join(hot, same).union(cold.join(rest, same)).drop(*(f"{k}_" for k in keys))


def per_document(levels: list[DataFrame], schema: str, work) -> DataFrame:
    """``work(places, words, ranks)`` for whole documents, a batch of them at once.

    Per level there are ascending places (the document's number in the batch times 2^32, and the line) and their ranks; words are
    those of level 0. What comes back has a ``place``, of which a column ``line`` is made, and the document's id and print.
    """
    rows = None
    for k, level in enumerate(levels):
        words_ = F.col("words") if k == 0 else F.lit(0)
        one = level.select(*DOC, F.struct(F.lit(k).alias("level"), "line", words_.alias("words"), "rank").alias("place"))
        rows = one if rows is None else rows.union(one)
    # Places met twice are those of rows that are alike in id and text.
    grouped = rows.groupBy(*DOC).agg(F.collect_set("place").alias("places"))
    arrow, height = to_arrow_schema(StructType.fromDDL(schema)), len(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("places")
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            flat = lists.flatten()
            level, line, weight, rank = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            place = of.astype(np.int64) << 32 | line
            order = np.lexsort((place, level))
            cuts = np.searchsorted(level[order], np.arange(height + 1))
            some = [order[x:y] for x, y in zip(cuts, cuts[1:])]
            out = work([place[o] for o in some], weight[some[0]], [rank[o] for o in some])
            if "place" in out:
                found = out.pop("place")
                out |= {c: batch.column(c).take(pa.array(found >> 32)) for c in DOC} | {"line": (found & 0xFFFFFFFF).astype(np.int32)}
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c := out[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow
            )

    return grouped.mapInArrow(run, schema)


def runs_at(places: np.ndarray, weight: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first place, lines, has ``least_words``) of the shortest runs within neighbouring places."""
    first = np.append(np.flatnonzero(np.diff(places, prepend=-2) != 1), len(places))
    found = [np.stack(shortest_runs(weight, first, least)) for least in (1, least_words)]
    start, length = np.unique(np.concatenate(found, axis=1), axis=1)
    total = np.concatenate(([0], np.cumsum(weight, dtype=np.int64)))
    return start, length, total[start + length] - total[start] >= least_words


def suffix_levels(docs: DataFrame, least_words: int) -> list[DataFrame]:
    """Stored (doc_id, print, line, rank) for runs of 1, 2, 4, ... lines, as far as a shortest run asks for it."""
    rows = stored(lines_of(docs), "lines")
    level, count = ranked(rows, rows.count())
    remove(rows)
    levels = [level]

    def longest(places, weight, ranks) -> dict:
        _, length, _ = runs_at(places[0], weight, least_words)
        return {"most": [int(length.max(initial=0))]}

    most = per_document(levels, "most long", longest).agg(F.max("most")).first()[0] or 0
    size = 1
    while 2 * size <= most and count:
        ahead = Window.partitionBy(*DOC).orderBy("line").rangeBetween(size, size)
        pairs = levels[-1].select(*DOC, "line", F.col("rank").alias("a"), F.min("rank").over(ahead).alias("b")).where("b is not null")
        level, count = ranked(pairs, count)
        levels.append(level)
        size *= 2
    return levels


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Stored (doc_id, print, line, length, goes, first) of shortest runs that occur elsewhere, ``first`` being the first place.

    ``docs`` has doc_id, text and print, which tells apart documents with one id. ``goes``: it has ``least_words``.
    """
    levels = suffix_levels(docs, least_words)

    def name(places, weight, ranks) -> dict:
        start, length, goes = runs_at(places[0], weight, least_words)
        a, b = np.full((2, len(start)), -1, np.int64)
        for k, (place, rank) in enumerate(zip(places, ranks)):
            here = np.flatnonzero((length >= 1 << k) & (length < 2 << k))
            if not len(here) or not len(place):
                continue
            first = places[0][start[here]]
            for out, wanted in ((a, first), (b, first + length[here] - (1 << k))):
                at = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
                out[here] = np.where(place[at] == wanted, rank[at], -1)
        both = (a >= 0) & (b >= 0)  # else a part of the run occurs nowhere else
        return {"place": places[0][start[both]], "length": length[both], "goes": goes[both], "a": a[both], "b": b[both]}

    schema = "doc_id long, print long, line int, length long, goes boolean, a long, b long"
    runs = stored(per_document(levels, schema, name), "line-runs")
    place = F.struct(*DOC, "line")
    first = runs.groupBy("length", "a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    first = first.select(*(F.col(c).alias(f"{c}_") for c in ("length", "a", "b")), "n", "first")
    found = stored(joined(runs, first, ["length", "a", "b"], runs.count()).select(*DOC, "line", "length", "goes", "first"), "repeated")
    remove(runs, *levels)
    return found


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Stored (doc_id, print, runs): per document the runs (line, length, goes) of which there is an earlier copy."""
    found = repeated_runs(docs, least_words)
    later = found.where(~F.struct(*DOC, "line").eqNullSafe(F.col("first")))
    later = stored(later.groupBy(*DOC).agg(F.collect_set(F.struct("line", "length", "goes")).alias("runs")), "later-runs")
    remove(found)
    return later


COUNTS = ("__n_lines", "__n_removed", "__n_runs", "__n_repeated", "__n_repeated_runs")


def with_removed(docs: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with the text shortened and the number of lines removed, in a column of the name given."""
    counts = free(docs, *COUNTS)
    return without_later_copies(docs, least_words, counts=tuple(counts)).select(*docs.columns, counts[1]), counts[1]


def without_later_copies(
    docs: DataFrame, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text_column: str = "text", counts: tuple[str, ...] = COUNTS
) -> DataFrame:
    """``docs`` with the text shortened, and ``__n_lines``, ``__n_removed`` lines and ``__n_runs`` removed runs.

    ``__n_repeated`` lines in ``__n_repeated_runs`` runs occur before, whatever their length.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # a column of docs may have any name
    own_id, own_text = (names[docs.columns.index(c)] for c in (id_column, text_column))
    plain = docs.toDF(*names).withColumns({"doc_id": F.col(own_id).cast("long"), "print": F.xxhash64(own_text)})
    found = later_copies(plain.select("doc_id", F.col(own_text).alias("text"), "print"), least_words)
    found = found.select(F.col("doc_id").alias("doc_id_"), F.col("print").alias("print_"), "runs")
    rows = plain.join(found, F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("print") == F.col("print_")), "left")
    rows = rows.select(*names, "runs")
    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names), *(f"`{c}` long" for c in counts)])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in (own_text, *counts)}
        for text, spans in zip(batch.column(own_text).to_pylist(), batch.column("runs").to_pylist()):
            rows = text.split("\n") if text else []
            gone, again = np.zeros((2, len(rows) + 1), np.int8)
            for span in spans or ():
                at = slice(span["line"], span["line"] + span["length"])
                again[at] = 1
                gone[at] |= span["goes"]
            if gone.any():
                text = "\n".join([row for row, g in zip(rows, gone) if not g])
            figures = (int(x) for flag in (gone, again) for x in (flag.sum(), (np.diff(flag, prepend=0) > 0).sum()))
            for column, value in zip(out.values(), (text, len(rows), *figures)):
                column.append(value)
        yield {n: batch.column(n) for n in names} | out

    done = by_batch(rows, schema, work)
    return done.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)), *counts)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_later_copies(docs).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.col("__n_runs").alias("n_runs"),
        F.col("__n_repeated").alias("n_repeated"),
        F.col("__n_repeated_runs").alias("n_repeated_runs"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"),
    )
