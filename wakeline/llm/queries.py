"""The queries of this package, each with the SQL of its result where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import codes, jaccard, language, lines, merkle, mixing, packing, quality, repeats, shards, token_files, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_files": token_files.op2_token_files,
    "op3_packing": packing.op3_packing,
    "pack_conversations": packing.pack_conversations,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_quality": quality.op5_quality,
    "op6_language": language.op6_language,
    "op7_repeats": repeats.op7_repeats,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_warc": warc.op9_warc,
    "op10_merkle": merkle.op10_merkle,
    "op11_ball_codes": codes.op11_ball_codes,
    "op12_ring_shards": shards.op12_ring_shards,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op9_warc": warc.SQL,
    "op11_ball_codes": codes.SQL,
}
