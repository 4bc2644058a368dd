"""The dealt queries and their DuckDB twins, by name."""

from __future__ import annotations

from netsift.llm import (
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality,
    spelling,
    token_counts,
    toxicity,
    warc,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_pii": pii.op3_pii,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_warc": warc.op5_warc,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_packing": packing.op7_packing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_chat_format": chat.op9_chat_format,
    "op10_quality": quality.op10_quality,
    "op11_spelling": spelling.op11_spelling,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_token_counts": token_counts.op13_token_counts,
}
ORACLES = {"op2_exact_dedup": exact_dedup.OP2_SQL, "op12_hard_negatives": hard_negatives.OP12_SQL}
