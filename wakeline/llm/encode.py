"""Ids of whole texts by a public tokenizer, each distinct piece of text encoded once per worker.

Texts are cut where the tokenizer itself always cuts, so that the pieces' ids, put together, are those of
``Tokenizer.encode`` of the whole text: before a single space between two characters that are not white space,
and between an ASCII letter and ASCII punctuation. Pieces are made distinct in Arrow, and the library is asked
only for pieces that this worker has not met (a bounded cache). Texts with other Unicode white space or with
``<|`` are given to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from wakeline.llm.words import _SPACE, fold, ranges, raw

#: Distinct pieces a worker remembers; beyond that it starts afresh.
CACHE = 200_000
_PLAIN = re.compile(r" ?[a-zA-ZÀ-ÖØ-öø-ÿ]+")
_PLAIN_FOLDED = re.compile(r"[a-zà-öø-ÿ]+")
#: First bytes of Unicode white space and of ``<|``, with the second bytes that make them so.
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3, ord("<"), 28, 29, 30, 31]] = True
_SECOND = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,), ord("<"): (ord("|"),)}
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[33:48] = _PUNCTUATION[58:65] = _PUNCTUATION[91:97] = _PUNCTUATION[123:127] = True


def _odd(data: np.ndarray) -> bool:
    """Whether the text has what the cuts do not allow for (or might have it)."""
    at = np.flatnonzero(_LEAD[data])
    if not len(at):
        return False
    lead, second = data[at], data[np.minimum(at + 1, len(data) - 1)]
    if (lead < 32).any():
        return True
    return any(np.isin(second[lead == a], b).any() for a, b in _SECOND.items())


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class Encoder:
    def __init__(self, path: str, folds: bool):
        """``folds``: the tokenizer lower-cases and drops white space."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.folds = folds
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.int32)
        self.at = np.zeros(1 << 16, np.int64)

    def _learn(self, new: list[str]) -> None:
        pattern = _PLAIN_FOLDED if self.folds else _PLAIN
        plain = [bool(pattern.fullmatch(x)) for x in new]
        rest = [x for x, p in zip(new, plain) if not p]
        full = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        model, letters = self.tokenizer.model, self.letters
        got, ends = [], []
        for x, p in zip(new, plain):
            if p:
                # Letters alone pass normaliser and splitter as they are, save for byte letters.
                x = x if x.isascii() and x[0] != " " else "".join([letters[b] for b in x.encode()])
                got += [t.id for t in model.tokenize(x)]
            else:
                got += next(full).ids
            ends.append(len(got))
        n, start = len(self.seen), self.at[len(self.seen)]
        while n + len(new) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        while start + len(got) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[start : start + len(got)] = got
        self.at[n + 1 : n + 1 + len(new)] = start + np.array(ends, np.int64)
        self.seen.update(zip(new, range(n, n + len(new))))

    def _squeezed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The text without white space, where its pieces start, and the first piece of each text."""
        kept = ~_SPACE[data]
        cut = kept.copy()
        cut[1:] &= ~kept[:-1] | (_LETTER[data[:-1]] & _PUNCTUATION[data[1:]])
        at = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[at] = kept[at]
        cut = np.flatnonzero(cut)
        place = np.concatenate(([0], np.cumsum(kept)))
        return data[kept], np.append(place[cut], place[-1]), np.searchsorted(cut, offsets)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1 : len(data) - 1] = (data[1:-1] == 32) & ~space[2:] & ~space[:-2]
        cut[1:-1] |= _LETTER[data[:-1]] & _PUNCTUATION[data[1:]]
        cut[offsets] = True
        return np.flatnonzero(cut)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's texts in order, and where each text's ids start."""
        data, offsets = raw(column)
        if _odd(data):
            return self._mixed(column)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
        if len(self.seen) > CACHE:
            self.forget()
        if self.folds:
            # White space is dropped by the tokenizer, so that pieces need not carry it.
            data, starts, first = self._squeezed(fold(data), offsets)
        else:
            starts = self._pieces(data, offsets)
            first = np.searchsorted(starts, offsets)
        pieces = pa.StringArray.from_buffers(
            len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if new := [x for x in distinct if x not in self.seen]:
            self._learn(new)
        code = np.array([self.seen[x] for x in distinct], np.int64)[pieces.indices.to_numpy()]
        lengths = self.at[code + 1] - self.at[code]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids[ranges(self.at[code], lengths)]
        return ids, ends[first]

    def _mixed(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text by text: the odd ones whole by the library, the others as above."""
        ids, ends = [], [0]
        for i in range(len(column)):
            text = column[i].as_py() or ""
            if _odd(np.frombuffer(text.encode(), np.uint8)):
                found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            else:
                found = self(column.slice(i, 1))[0]
            ids.append(found)
            ends.append(ends[-1] + len(found))
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(ends, np.int64)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(name: str, folds: bool) -> Encoder:
    """This worker's encoder for a vocabulary file: a path, or a name in ``public_tokenizers``."""
    if (name, folds) not in _ENCODERS:
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        else:
            path = name
        _ENCODERS[name, folds] = Encoder(path, folds)
    return _ENCODERS[name, folds]


def with_end(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text."""
    n = len(starts) - 1
    starts = starts + np.arange(n + 1)
    out = np.full(int(starts[-1]), end, np.int32)
    keep = np.ones(len(out), bool)
    keep[starts[1:] - 1] = False
    out[keep] = ids
    return out, starts
