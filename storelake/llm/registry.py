"""Queries of the training-data operators and the SQL that some of them can be held against."""

from storelake.llm import (
    ann,
    chat,
    contamination,
    licenses,
    line_dedup,
    mixing,
    negatives,
    packing,
    quality,
    runs,
    simhash,
    token_files,
    toxicity,
)

QUERIES = {
    "op1_lines": line_dedup.op1_lines,
    "op2_tokens": token_files.op2_tokens,
    "op3_mixing": mixing.op3_mixing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_licenses": licenses.op5_licenses,
    "op6_ann": ann.op6_ann,
    "op7_quality": quality.op7_quality,
    "op8_packing": packing.op8_packing,
    "op9_chat": chat.op9_chat,
    "op10_simhash": simhash.op10_simhash,
    "op11_negatives": negatives.op11_negatives,
    "op12_runs": runs.op12_runs,
    "op13_contamination": contamination.op13_contamination,
}

ORACLES = {
    "op7_quality": quality.ORACLE,
    "op9_chat": chat.ORACLE,
    "op11_negatives": negatives.ORACLE,
    "op13_contamination": contamination.ORACLE,
}
