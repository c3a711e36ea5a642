"""Codes and whitening of vectors, against plain numpy; sharding against a document-by-document ring."""

import hashlib

import numpy as np
import pytest

from wakeline.llm import codes, shards, vectors, whitening
from wakeline.llm.common import stored

SCHEMA = "vec_id long, embedding array<float>, label int, k_0 string, d int"


def plain_codes(vecs, parts=4, entries=256, rounds=4):
    """(codes, errors, codebooks) by a look at every entry."""
    x = np.floor(1024 * np.array(vecs, np.float64)).astype(np.int64)
    width = -(-x.shape[1] // parts)
    x = np.pad(x, ((0, 0), (0, parts * width - x.shape[1])))
    cut = [x[:, i * width : (i + 1) * width] for i in range(parts)]
    books = [c[:entries].copy() for c in cut]

    def assign(points, book):
        d = ((points[:, None, :] - book[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for c, book in zip(cut, books):
            at, _ = assign(c, book)
            for j in set(at.tolist()):
                book[j] = c[at == j].sum(0) // (at == j).sum()
    found = [assign(c, b) for c, b in zip(cut, books)]
    return np.stack([a for a, _ in found], 1), sum(e for _, e in found), books


def odd_vectors(d=8, n=400):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, d))
    rows = []
    for i in range(n):
        v = (centres[i % 9] + 0.2 * rng.normal(size=d)).astype(np.float32).tolist()
        rows.append((i, v, i % 4 if i % 7 else None, "clash", i))
    rows += [(n + i, rows[i % 3][1], 1, None, 0) for i in range(60)]  # copies: ties between entries and parts
    rows += [(n + 100, None, 1, "", 0), (n + 101, [], 1, "", 0), (n + 102, [1.0] * (d - 1), 1, "", 0)]
    rows += [(n + 103, [None] + [1.0] * (d - 1), 1, "", 0), (n + 104, [float("nan")] * d, 1, "", 0), (n + 105, [float("-inf")] * d, None, "", 0)]
    rows += [(-4, [0.0] * d, 2, "", 0), (None, [0.25] * d, 2, "", 0), (7, rows[7][1], 0, "", 0)]
    return rows


def sound(rows, d):
    kept = [r for r in rows if r[1] is not None and len(r[1]) == d and all(c is not None and np.isfinite(c) for c in r[1])]
    return sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.floor(1024 * np.array(r[1])).tolist()))


@pytest.mark.parametrize("d, entries", [(8, 256), (8, 16), (6, 5), (3, 256)])
def test_codes_as_by_a_look_at_every_entry(spark, d, entries):
    rows = odd_vectors(d)
    kept = sound(rows, d)
    code, error, books = plain_codes([r[1] for r in kept], entries=entries)
    found, got = codes.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=entries)
    assert [b.tolist() for b in got] == [b.tolist() for b in books]
    expected = sorted((str(r[0]), str(r[2]), c, e) for r, c, e in zip(kept, code.tolist(), error.tolist()))
    assert sorted((str(r.k_0), str(r.k_1), list(r.code), r.error) for r in found.collect()) == expected
    sums = {}
    for r, e in zip(kept, error.tolist()):
        sums[r[2]] = sums.get(r[2], 0) + e
    assert all(r.label_error == sums[r.k_1] for r in codes.with_label_error(found).collect())


def test_balls_leave_nothing_out():
    rng = np.random.default_rng(3)
    points = rng.integers(-40, 40, (700, 3))
    entries = rng.integers(-40, 40, (60, 3))
    entries[7] = entries[3]
    held = rng.integers(0, 60, 700)
    far = ((points - entries[held]) ** 2).sum(1)
    reach = np.full(60, -1)
    np.maximum.at(reach, held, 4 * far)
    best, least = codes.nearest(points, entries)
    ball = codes.Balls(entries, reach)
    again, same = ball.move(points, held)
    assert (again == best).all() and (same == least).all()
    stays, _ = codes.Balls(entries, np.full(60, 0)).move(points, best)
    assert (np.abs(entries[stays] - entries[best]).sum(1) == 0).all()


@pytest.mark.parametrize("low, high", [(-1, 1), (-(1 << 25), 1 << 25)])
def test_distances_are_whole(low, high):
    rng = np.random.default_rng(1)
    a, b = rng.integers(low, high + 1, (50, 7)), rng.integers(low, high + 1, (20, 7))
    assert (codes.squared(a, b).astype(np.int64) == ((a[:, None] - b[None]) ** 2).sum(2)).all()


def test_no_vectors(spark):
    empty = spark.createDataFrame([(1, None, 1, "", 0), (2, [None], 1, "", 0)], SCHEMA)
    found, books = codes.vector_codes(empty)
    assert found.count() == 0 and books == []
    assert vectors.longest(stored(vectors.blocks(empty.limit(0), "embedding", ["vec_id"], 64.0))) == 0


def test_queries_of_an_empty_table(spark, tmp_path):
    for name, schema in (("embeddings", SCHEMA), ("documents", "doc_id long, text string, shard int, n long")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for query, columns in (
        (codes.op11_ball_codes, ["vec_id", "code", "error", "label_error", "codebooks_sha256"]),
        (shards.op12_ring_shards, ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
        (whitening.op13_whitening, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]),
    ):
        found = query(spark, str(tmp_path))
        assert found.columns == columns and found.count() == 0


def whitened(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return whitening.op13_whitening(spark, str(tmp_path)).collect()


def test_whitening_next_to_eigenvectors(spark, tmp_path):
    d, rows = 8, odd_vectors(8)
    kept = sound(rows, d)
    x = np.floor(64 * np.array([r[1] for r in kept], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    found = whitened(spark, tmp_path, rows)
    assert len(found) == n * d and {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, d + 1))
    assert max(r.identity_error for r in found) < 1e-9
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
    expected = centred @ v / np.sqrt(e)
    sign = np.zeros(d)
    for i, row in enumerate(kept):
        if row[0] == 7:  # two rows of this id
            continue
        got = sorted(by_id[row[0]], key=lambda r: r.component)
        y = np.array([r.whitened for r in got])
        sign = np.where(sign == 0, np.sign(y * expected[i]), sign)
        assert np.allclose(y * sign, expected[i], atol=1e-8)
        assert {r.deviation for r in got} == {int(((n * x[i] - sums) ** 2).sum())}
        assert np.allclose([r.explained for r in got], e / e.sum(), rtol=1e-9)


def test_repeated_and_missing_eigenvalues(spark, tmp_path):
    """Three equal eigenvalues, a constant dimension and a dimension that repeats another."""
    rows = [(i, [float(s * (i % 3 == k)) for k in range(3) for s in [1 if i % 2 else -1]] + [5.0, float(i % 6 == 1)], None, "", 0) for i in range(60)]
    rows = [(i, v + [v[4]], label, k, d) for i, v, label, k, d in rows]
    found = whitened(spark, tmp_path, rows)
    x = np.floor(64 * np.array([r[1] for r in rows]))
    e = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    rank = int((e > 1e-9).sum())
    assert len(found) == 60 * rank and max(r.identity_error for r in found) < 1e-9
    share = {r.component: r.explained for r in found}
    assert np.allclose([share[c] for c in sorted(share)], e[:rank] / e.sum())


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 20, 0], [0, 0]])
    n, sums = 10**6, np.array([0, 0])
    assert whitening.deviations(x, 10**3, sums).to_pylist() == [(10**3 << 20) ** 2, 0]
    assert whitening.deviations(x, n * 10**6, sums).to_pylist() == [None, 0]


def by_hand(rows, count, points, slack=0.0):
    """Rounds over single documents: (id, text) to shard, as a multiset."""
    places, owner = shards.ring(count, points)
    waiting = []
    for name, text in rows:
        digest = "null" if text is None else hashlib.md5(text.encode()).hexdigest()
        own = str(name) if name is not None else f"null:{digest}"
        place = int(hashlib.md5(f"{shards.SEED}:{own}".encode()).hexdigest()[: shards.PLACE], 16)
        arc = int(np.searchsorted(places, place)) % len(places)
        waiting.append([arc, hashlib.md5(f"{own}|{digest}".encode()).hexdigest(), arc, name, text])
    room = shards.capacities(len(rows), count, slack)
    out = []
    while waiting:
        left = []
        for doc in sorted(waiting, key=lambda w: w[:2]):
            shard = int(owner[doc[2]])
            if room[shard]:
                room[shard] -= 1
                out.append((str(doc[3]), str(doc[4]), shard))
            else:
                left.append(doc)
        for doc in left:
            doc[2] = next(i % len(places) for i in range(doc[2] + 1, doc[2] + 1 + len(places)) if room[int(owner[i % len(places)])])
        waiting = left
    return sorted(out)


@pytest.mark.parametrize("count, points, slack", [(16, 8, 0.0), (3, 64, 0.0), (5, 16, 0.2), (1, 1, 0.0)])
def test_ring_document_by_document(spark, odd, count, points, slack):
    rows = [(r.doc_id, r.text) for r in odd.collect()] * 3 + [(i, f"text {i % 40}") for i in range(300)] + [(5, "hot")] * 90 + [(None, f"null {i}") for i in range(80)]
    docs = spark.createDataFrame([(a, b, "x", 1, 2) for a, b in rows], "doc_id long, text string, shard string, slot int, n long")
    digest = whitening.F.coalesce(whitening.F.md5("text"), whitening.F.lit("null"))
    place, key = shards.place_and_key(docs.doc_id, digest)
    groups = docs.withColumns({"place": place, "key": key}).groupBy("place", "key").agg(
        whitening.F.count("*").alias("n"), whitening.F.first("doc_id").alias("doc_id"), whitening.F.first("text").alias("text")
    )
    found = shards.placed(groups, count, points, slack).collect()
    assert sorted((str(r.doc_id), str(r.text), r.shard) for r in found for _ in range(r.low, r.high + 1)) == by_hand(rows, count, points, slack)
    slots = sorted((r.shard, s) for r in found for s in range(r.low, r.high + 1))
    assert slots == sorted((s, i) for s in range(count) for i in range(sum(t == s for t, _ in slots)))


def test_whole_rows_are_dealt_and_few_move(spark, odd, tmp_path):
    docs = odd.union(odd.limit(6)).withColumn("__slot", odd.start)
    found = shards.shard_documents(docs.drop("__slot"), shards=4, points=32)
    assert sorted(map(str, found.drop("__shard", "__slot").collect())) == sorted(map(str, docs.drop("__slot").collect()))
    many = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text")
    before = {r.doc_id: r["__shard"] for r in shards.shard_documents(many).collect()}
    after = {r.doc_id: r["__shard"] for r in shards.shard_documents(many, shards=17).collect()}
    assert sum(before[i] != after[i] for i in before) / 4000 < 2 / 17
    counts = np.bincount(list(before.values()))
    assert counts.max() - counts.min() <= 1
    shards.write_shards(many, f"{tmp_path}/shards", shards=4, points=64)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 4000 and back.select("__shard", "__slot").distinct().count() == 4000
