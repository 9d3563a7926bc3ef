"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    balltree,
    bpe,
    exactdedup,
    packing,
    pii,
    quality,
    qualityrules,
    simhash,
    spelling,
    substrings,
    toxicity,
    turns,
    urlglob,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        substrings.op1_substring_dedup,
        urlglob.op2_url_filter,
        simhash.op3_simhash,
        toxicity.op4_toxicity,
        quality.op5_quality,
        packing.op6_pack,
        balltree.op7_ball_tree,
        pii.op8_pii,
        exactdedup.op9_exact_dedup,
        bpe.op10_bpe_chunks,
        spelling.op11_spelling_variants,
        qualityrules.op12_quality_rules,
        turns.op13_conversation_repair,
    )
}

ORACLE: dict[str, str] = {
    "op2_url_filter": urlglob.OP2_SQL,
    "op7_ball_tree": balltree.OP7_SQL,
    "op9_exact_dedup": exactdedup.OP9_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op13_conversation_repair": turns.OP13_SQL,
}
