"""Vector bin packing of examples into training sequences.

An example is a vector (tokens, one segment, loss-bearing tokens), and a sequence has limits on all three. For
the sequence being filled, the example with the greatest dot product between its vector and the room that is
left (both in shares of the limits) is placed, so that scarce room decides. Where nothing fits whole, the example
with the greatest product is cut to fill the room (``cut=True``), or the sequence is closed. Each task packs the
rows it reads, from a window of ``WINDOW`` candidates that is refilled as they are placed, so that memory is bounded
and nothing is shuffled. A sequence that stays short (its segments or loss-bearing tokens are full, or a task ends) is, where
cutting is allowed, cut down to a power of two, which needs no padding; the rest of it waits for the next one.

Loss-bearing tokens are those from ``loss_from`` to an example's end (instruction data: the answer).

Defined cases: a null or empty text has the end id alone; repeated rows are packed each; an empty table gives no
rows; an example above a limit is cut, or, with ``cut=False``, refused with a ValueError.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wakeline.llm.common import read, release
from wakeline.llm.encode import encoder, with_end
from wakeline.llm.words import slices

LENGTH = 2048
SEGMENTS = 256
WINDOW = 256


class Packer:
    """Fills sequences one after another from a bounded window of candidates.

    ``add`` takes (key, tokens, loss_from); ``placed`` gathers (key, start, length, sequence, offset).
    """

    def __init__(self, limits: tuple[int, int, int], cut: bool = True, window: int = WINDOW, powers: bool = True):
        self.limits, self.cut, self.window, self.powers = np.array(limits, np.float64), cut, window, powers
        self.length, self.segments, self.loss = limits
        # Candidates: key, start of what is left, tokens left, loss-bearing tokens left. Rests of cut examples and of
        # sequences cut down add to the window, so that it is wider for a while.
        self.pool = np.zeros((4, window + self.segments), np.int64)
        self.n = 0
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.sequence = 0
        self.open: list[tuple[int, int, int, int, int]] = []  # key, start, tokens, offset, loss-bearing tokens
        self.used = [0, 0, 0]

    def add(self, key: int, tokens: int, loss_from: int = 0) -> None:
        loss = tokens - min(max(loss_from, 0), tokens)
        if not self.cut and (tokens > self.length or loss > self.loss or self.segments < 1):
            raise ValueError(f"an example of {tokens} tokens, {loss} of them loss-bearing, is above the limits")
        start = 0
        # What fills whole sequences by itself needs no neighbour.
        while self.cut and tokens - start >= self.length and min(loss, self.length) <= self.loss:
            # A sequence takes its number when it is closed, so the open one does not mind.
            self.placed.append((key, start, self.length, self.sequence, 0))
            self.sequence += 1
            start += self.length
            loss = min(loss, tokens - start)
        if start < tokens:
            self._hold(key, start, tokens - start, loss)
            while self.n >= self.window:
                self._step()

    def _hold(self, key: int, start: int, tokens: int, loss: int) -> None:
        if self.n == self.pool.shape[1]:
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)), axis=1)
        self.pool[:, self.n] = key, start, tokens, loss
        self.n += 1

    def _room(self) -> tuple[int, int, int]:
        return self.length - self.used[0], self.segments - self.used[1], self.loss - self.used[2]

    def _close(self) -> None:
        pieces, total = self.open, self.used[0]
        self.open, self.used = [], [0, 0, 0]
        whole = 1 << (total.bit_length() - 1) if self.cut and self.powers and 0 < total < self.length else total
        for key, start, n, offset, loss in pieces:
            here = min(n, max(0, whole - offset))
            if here:
                self.placed.append((key, start, here, self.sequence, offset))
            if here < n:  # an example's loss is at its end
                self._hold(key, start + here, n - here, min(loss, n - here))
        self.sequence += 1

    def _put(self, i: int, tokens: int) -> None:
        """Place the first ``tokens`` of candidate ``i``; the rest of it stays a candidate."""
        key, start, left, loss = self.pool[:, i].tolist()
        quiet = left - loss
        bears = max(0, tokens - quiet)
        self.open.append((key, start, tokens, self.used[0], bears))
        self.used = [self.used[0] + tokens, self.used[1] + 1, self.used[2] + bears]
        if tokens == left:
            self.n -= 1
            self.pool[:, i] = self.pool[:, self.n]
        else:
            self.pool[:, i] = key, start + tokens, left - tokens, loss - bears
        if self.used[0] == self.length or self.used[1] == self.segments:
            self._close()

    def _step(self) -> None:
        """Place one candidate, or part of one, or close the sequence."""
        tokens, segments, loss = self._room()
        sizes, losses = self.pool[2, : self.n], self.pool[3, : self.n]
        weight = np.array([tokens, segments, loss]) / self.limits**2
        score = sizes * weight[0] + weight[1] + losses * weight[2]
        fits = (sizes <= tokens) & (losses <= loss)
        if fits.any():
            self._put(i := int(np.argmax(np.where(fits, score, -1))), int(self.pool[2, i]))
            return
        if self.cut:
            # As much of each as fits: its tokens without loss, and as many loss-bearing ones as there is room for.
            part = np.minimum(np.minimum(sizes, tokens), sizes - losses + loss)
            i = int(np.argmax(np.where(part > 0, score, -1)))
            if part[i] > 0:
                self._put(i, int(part[i]))
                return
        self._close()

    def drain(self) -> list[tuple[int, int, int, int, int]]:
        done, self.placed = self.placed, []
        return done

    def finish(self) -> None:
        while self.n or self.open:
            if self.n:
                self._step()
            else:
                self._close()


PIECES = "start long, length long, sequence_id long, offset long"


def _first_sequence() -> int:
    """Sequence numbers of a task start here, so that tasks need not know of each other."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 40


def pack_examples(
    examples: DataFrame,
    limits: tuple[int, int, int] = (LENGTH, SEGMENTS, LENGTH),
    cut: bool = False,
    id_column: str = "doc_id",
    tokens: str = "tokens",
    loss_from: str | None = None,
) -> DataFrame:
    """Pack examples of known length: (id, start, length, sequence_id, offset) per piece; null lengths count as 0."""
    data = examples.select(
        F.col(id_column),
        F.coalesce(F.col(tokens).cast("long"), F.lit(0)).alias("__tokens"),
        F.coalesce(F.col(loss_from).cast("long"), F.lit(0)).alias("__from") if loss_from else F.lit(0).cast("long").alias("__from"),
    )

    kind = to_arrow_type(data.schema[id_column].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first, ids, at = Packer(limits, cut), _first_sequence(), {}, 0

        def out(rows):
            key, start, length, sequence, offset = (list(x) for x in zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in key], kind), *(pa.array(x, pa.int64()) for x in (start, length, [first + s for s in sequence], offset))],
                [id_column, "start", "length", "sequence_id", "offset"],
            )

        for batch in batches:
            for key, n, quiet in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids[at] = key
                packer.add(at, n, quiet)
                at += 1
            if rows := packer.drain():
                yield out(rows)
                alive = {*packer.pool[0, : packer.n].tolist(), *(k for k, *_ in packer.open)}
                ids = {k: v for k, v in ids.items() if k in alive}
        packer.finish()
        if rows := packer.drain():
            yield out(rows)

    return data.mapInArrow(work, f"`{id_column}` {data.schema[id_column].dataType.simpleString()}, {PIECES}")


def pack_texts(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    folds: bool = False,
    end_id: int = 1,
    limits: tuple[int, int, int] = (LENGTH, SEGMENTS, LENGTH),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode whole texts, cut freely and pack; every id bears loss."""
    data = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first, at = Packer(limits), _first_sequence(), 0
        held: dict[int, list] = {}  # of examples not yet placed: id, ids, ids left

        def out(rows):
            columns: list[list] = [[], [], [], [], [], [], []]
            for key, start, n, sequence, offset in rows:
                mine = held[key]
                piece = (mine[0], start, n, zlib.crc32(mine[1][4 * start : 4 * (start + n)]), len(mine[1]) // 4, first + sequence, offset)
                for column, value in zip(columns, piece):
                    column.append(value)
                mine[2] -= n
                if not mine[2]:
                    del held[key]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

        for batch in batches:
            names, text = batch.column("doc_id").to_pylist(), batch.column("text")
            for i, j in slices(text):
                ids, starts = with_end(*encoder(tokenizer, folds)(text.slice(i, j - i)), end_id)
                starts = starts.tolist()
                for k in range(j - i):
                    n = starts[k + 1] - starts[k]
                    held[at] = [names[i + k], memoryview(ids[starts[k] : starts[k + 1]].astype("<u4").tobytes()), n]
                    packer.add(at, n)
                    at += 1
                if rows := packer.drain():
                    yield out(rows)
        packer.finish()
        if rows := packer.drain():
            yield out(rows)
        release()

    return data.mapInArrow(work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def conversation_examples(turns: DataFrame, tokenizer: str = "byte_bpe_50k.json", answers: str = "assistant") -> DataFrame:
    """(conv_id, turn, tokens, loss_from) of every answer with the question before it: the answer bears the loss.

    An example is one turn of ``answers`` and what others said since the last such turn, each text with an end id. Turns
    of a conversation are put in order in one task, a number per turn; a null conversation is dealt out by its texts, each turn an example
    of its own. What no answer follows has no loss.
    """
    from pyspark.sql import Window

    data = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role") == answers, F.lit(False)).alias("own"), "text"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text):
                _, starts = with_end(*encoder(tokenizer, False)(text.slice(i, j - i)), 1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in ("conv_id", "turn", "own")), pa.array(np.diff(starts), pa.int64())],
                    ["conv_id", "turn", "own", "n"],
                )

    kind = data.schema["conv_id"].dataType.simpleString()
    counted = data.mapInArrow(count, f"conv_id {kind}, turn long, own boolean, n long")
    known = counted.where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy("turn", "own", "n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("example", F.coalesce(F.sum(F.col("own").cast("long")).over(before), F.lit(0)))
    known = known.groupBy("conv_id", "example").agg(
        F.min("turn").alias("turn"), F.sum("n").alias("tokens"), F.sum(F.when(~F.col("own"), F.col("n")).otherwise(0)).alias("loss_from")
    )
    alone = counted.where("conv_id is null").select("conv_id", "turn", F.col("n").alias("tokens"), F.when(F.col("own"), 0).otherwise(F.col("n")).alias("loss_from"))
    return known.select("conv_id", "turn", "tokens", "loss_from").unionByName(alone)


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with their questions, whole, in sequences of 2048 tokens, 16 examples and 1024 loss-bearing tokens at most.

    A longer example is cut; so limits of all three kinds bind.
    """
    examples = conversation_examples(read(spark, sf_dir, "conversations"))
    name = F.struct("conv_id", "turn")
    return pack_examples(examples.withColumn("name", F.to_json(name)), (LENGTH, 16, LENGTH // 2), True, "name", "tokens", "loss_from")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(read(spark, sf_dir, "documents"))
