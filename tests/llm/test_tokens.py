"""Token files and packing against the tokenizers library run text by text."""

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wakeline.llm import packing, token_files
from wakeline.llm.common import fresh_path
from wakeline.llm.encode import encoder


@functools.cache
def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(name, text):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,folds", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, folds):
    rnd = random.Random(7)
    alphabet = [*"ab Z.,'  \n\té1 2|<", "<|endoftext|>", " ", "ß", "　", " the", "'s", "É", "İ", "Σ", "\x1c", "日", "½"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + [None]
    ids, starts = encoder(name, folds)(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(name, text)[:-1], text


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 20000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.03, rng.integers(0, 2**32 - 1, n), rng.integers(700, 900, n)).astype(np.uint32)
    entries, data = token_files.pack(ids)
    assert np.array_equal(token_files.unpack(entries, data), ids)
    if n > 4096:
        assert len(data) < 3 * n  # outliers do not widen the blocks


def test_any_range_of_a_file_reads_alone():
    ids = np.random.default_rng(1).integers(0, 49000, 30000).astype(np.uint32)
    file = token_files.TokenFile(token_files.file_bytes([5, None], np.array([10000, 20000]), ids))
    assert file.doc_ids == [5, None]
    for a, b in ((0, 30000), (4095, 4097), (8192, 8192), (29999, 30000)):
        assert np.array_equal(file.ids(a, b), ids[a:b])


def tokens_by_hand(rows):
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = ids_of("word_bpe_49k.json", r.text)
        out.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["odd", "sample", "empty"])
def test_files_hold_every_document(spark, odd, sample, which):
    docs = {"odd": odd, "sample": sample, "empty": odd.limit(0)}[which]
    folder = fresh_path(spark, "tokens")
    token_files.write_tokens(docs, folder, file_ids=3000)
    got = sorted(map(tuple, token_files.read_documents(spark, folder).collect()), key=lambda r: r[1])
    assert got == tokens_by_hand(docs.collect())


def check_packing(pieces, docs, limits):
    length, segments, loss = limits
    expected = sorted((r.doc_id is None, r.doc_id or 0, tuple(ids_of("byte_bpe_50k.json", r.text))) for r in docs)
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert ps[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(ps, ps[1:]))
        assert sum(p.length for p in ps) <= length and len(ps) <= segments
    for null, doc_id, ids in expected:
        ps = by_doc[None if null else doc_id, len(ids)]
        wanted = {(p.start, p.length): crc(ids[p.start : p.start + p.length]) for p in ps}
        assert all(p.ids_crc32 == wanted[p.start, p.length] for p in ps)
        copies = sum(1 for e in expected if e == (null, doc_id, ids))
        assert sum(p.length for p in ps) == copies * len(ids)
    assert sum(len(ps) for ps in by_doc.values()) == len(pieces)
    padding = sum(0 if (n := sum(p.length for p in ps)) & (n - 1) == 0 else length - n for ps in by_sequence.values())
    return padding, sum(p.length for p in pieces)


@pytest.mark.parametrize("which", ["odd", "sample"])
def test_pieces_cover_every_id_once(spark, odd, sample, which):
    docs = {"odd": odd, "sample": sample}[which]
    pieces = packing.pack_texts(docs).collect()
    padding, total = check_packing(pieces, docs.collect(), (2048, 256, 2048))
    assert padding <= 0.01 * total


def test_texts_of_a_few_tokens_need_no_padding(spark):
    """The limit on segments closes sequences long before they are full."""
    docs = spark.createDataFrame([(i, "a b") for i in range(4000)] + [(4000 + i, "x") for i in range(900)], "doc_id long, text string")
    padding, total = check_packing(packing.pack_texts(docs).collect(), docs.collect(), (2048, 256, 2048))
    assert padding == 0 and total > 9000


@pytest.mark.parametrize("seed", [1, 6])
def test_rests_of_cut_examples_may_exceed_the_window(spark, seed):
    """Loss closes a sequence over and over, so that the rests of many examples wait at once."""
    rnd = random.Random(seed)
    rows = [(k, rnd.randint(1025, 4000), rnd.randint(1, 60)) for k in range(600)]
    examples = spark.createDataFrame(rows, "k long, n long, quiet long").coalesce(1).sortWithinPartitions("k")
    pieces = packing.pack_examples(examples, (2048, 16, 1024), True, "k", "n", "quiet").collect()
    spans, used = {}, {}
    for p in pieces:
        spans.setdefault(p.k, []).append((p.start, p.start + p.length))
        u = used.setdefault(p.sequence_id, [0, 0, 0])
        for i, x in enumerate((p.length, 1, max(0, p.start + p.length - max(p.start, rows[p.k][2])))):
            u[i] += x
    for k, n, _ in rows:
        ends = sorted(spans[k])
        assert ends[0][0] == 0 and ends[-1][1] == n and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert all(u[0] <= 2048 and u[1] <= 16 and u[2] <= 1024 for u in used.values())


def test_conversations(spark, tmp_path):
    rnd = random.Random(8)
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 7)):
            rows.append((conv, turn, "assistant" if turn % 2 else "user", "word " * rnd.choice([0, 3, 60, 700]), 1))
    rows += [(1000 + i, 1, "assistant", "ok", 1) for i in range(400)]
    rows += [(None, 1, "assistant", "no conversation", 1), (3, None, None, None, 1), (4, 9, "assistant", "b " * 5000, 1)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, tokens int").write.parquet(f"{tmp_path}/conversations.parquet")
    pieces = packing.pack_conversations(spark, str(tmp_path)).collect()
    expected, held = {}, {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        n = len(ids_of("byte_bpe_50k.json", text))
        mine = held.setdefault(conv, [turn, 0, 0])
        mine[0] = turn if mine[0] is None else mine[0]
        mine[1] += n
        if role == "assistant":
            name = "{" + ",".join(f'"{k}":{v}' for k, v in (("conv_id", conv), ("turn", mine[0])) if v is not None) + "}"
            expected[name] = (mine[1], mine[2])
            del held[conv]
        else:
            mine[2] += n
    for conv, (turn, n, quiet) in held.items():
        expected["{" + ",".join(f'"{k}":{v}' for k, v in (("conv_id", conv), ("turn", turn)) if v is not None) + "}"] = (n, quiet)
    parts, sequences = {}, {}
    for p in pieces:
        parts.setdefault(p.name, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append(p)
    assert set(parts) == set(expected)
    for name, (n, _) in expected.items():
        spans = sorted(parts[name])
        assert spans[0][0] == 0 and sum(x for _, x in spans) == n and all(a + x == b for (a, x), (b, _) in zip(spans, spans[1:]))
    full = {0: 0, 1: 0, 2: 0}
    for ps in sequences.values():
        used = (sum(p.length for p in ps), len(ps), sum(max(0, p.start + p.length - max(p.start, expected[p.name][1])) for p in ps))
        assert used[0] <= 2048 and used[1] <= 16 and used[2] <= 1024
        for k, most in enumerate((2048, 16, 1024)):
            full[k] += used[k] == most
    assert all(full.values())


def test_empty_table(odd):
    assert packing.pack_texts(odd.limit(0)).collect() == []


@pytest.mark.parametrize("cut", [True, False])
def test_all_three_limits_hold(cut):
    rnd = random.Random(3)
    limits = (512, 9, 150)
    packer = packing.Packer(limits, cut=cut, window=32)
    examples = {}
    for key in range(700):
        n = rnd.randint(1, 300)
        quiet = rnd.randint(max(0, n - 150), n)
        examples[key] = (n, quiet)
        packer.add(key, n, quiet)
    packer.finish()
    sequences, parts = {}, {}
    for key, start, n, sequence, offset in packer.drain():
        sequences.setdefault(sequence, []).append((offset, key, start, n))
        parts.setdefault(key, []).append((start, n))
    for rows in sequences.values():
        rows.sort()
        assert len(rows) <= 9 and sum(r[3] for r in rows) <= 512
        assert sum(max(0, s + n - max(s, examples[k][1])) for _, k, s, n in rows) <= 150
    for key, (n, _) in examples.items():
        spans = sorted(parts[key])
        assert spans[0][0] == 0 and sum(x for _, x in spans) == n
        assert cut or len(spans) == 1
    # First fit in order of arrival, for comparison.
    bins = []
    for n, quiet in examples.values():
        for b in bins:
            if b[0] + n <= 512 and b[1] < 9 and b[2] + n - quiet <= 150:
                break
        else:
            bins.append(b := [0, 0, 0])
        b[0] += n
        b[1] += 1
        b[2] += n - quiet
    if not cut:
        assert len(sequences) <= 1.1 * len(bins)


def test_examples_above_a_limit_are_refused_unless_cut():
    with pytest.raises(ValueError):
        packing.Packer((100, 4, 100), cut=False).add(0, 101)


def test_examples_of_known_length(spark):
    rows = [(i, 40 + i % 50, 30) for i in range(300)] + [(None, 5, None), (7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, n long, quiet long")
    got = packing.pack_examples(df, (128, 8, 64), tokens="n", loss_from="quiet").collect()
    assert sum(r.length for r in got) == sum(r[1] or 0 for r in rows)
    assert all(r.start == 0 for r in got)
