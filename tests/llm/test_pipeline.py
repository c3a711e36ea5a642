"""Each stage on what the one before kept, against plain Python."""

import os
from collections import Counter

import pytest
import test_documents
import test_jaccard
import test_tokens
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from wakeline.llm import lines
from wakeline.llm.common import stored


@pytest.mark.parametrize("which", ["odd", "sample", "empty"])
def test_stages(spark, odd, which):
    folder = f"{DATA}/sf0.001"
    if which == "sample" and not os.path.isdir(folder):
        pytest.skip("test tables absent")
    docs = {"odd": odd, "sample": spark.read.parquet(f"{folder}/documents.parquet") if which == "sample" else None, "empty": odd.limit(0)}[which]
    columns = docs.columns
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder))
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "language":
            kept = Counter(map(tuple, rows))
            assert not kept - Counter(map(tuple, before))
            assert which != "sample" or len(rows) >= 0.99 * len(before)
            assert all(any(c.isalpha() for c in r.text) for r in rows)
        elif name == "line_dedup":
            expected = test_documents.deduped_pairwise(before, lines.LEAST_WORDS)
            left = [(e[0], e[3]) for e in expected if not e[2] or test_documents.WORD.search(e[3])]
            assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((a, str(b)) for a, b in left)
            assert len(rows) >= 0.8 * len(before)
        elif name == "ngram_jaccard":
            groups = {c for _, n, c in test_jaccard.by_hand(before) if n}
            assert len(rows) == len(groups) + sum(not test_jaccard.shingles(r.text) for r in before)
            assert {r.doc_id for r in rows if r.doc_id is not None} >= {c for c in groups if c is not None}
        elif name == "mixing":
            copies = Counter(map(tuple, rows))
            times = Counter(map(tuple, before))
            assert set(copies) <= set(times) and all(copies[k] <= 2 * times[k] for k in copies)
        else:
            padding, total = test_tokens.check_packing(rows, before, (2048, 256, 2048))
            assert padding <= 0.01 * max(1, total)
        before = rows


def test_run_gives_the_last_stage(spark):
    folder = f"{DATA}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_columns_that_clash_stay_as_they_are(spark, odd):
    """Columns named like those that stages work with."""
    own = ("score", "lang_pred", "__n_removed", "__print", "__id", "__text", "__runs", "__size", "__key", "__copies", "digest", "copies", "runs", "rank")
    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", "n_chars", *(F.lit(f"own {c}").alias(c) for c in own))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""))
        assert docs.columns == columns, name
        assert all(r[c] == f"own {c}" for r in docs.collect() for c in own), name
