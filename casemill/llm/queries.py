"""The registered queries of this package and their SQL."""

from __future__ import annotations

from casemill.llm import chat_repair, decontam, exact_dedup, hard_negatives, interpolation, lexical, line_dedup, mixing, near_dedup, token_output, toxicity, url_filter, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_token_output": token_output.op4_token_output,
    "op5_interpolation": interpolation.op5_interpolation,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_decontam": decontam.op7_decontam,
    "op8_chat_repair": chat_repair.op8_chat_repair,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_lexical": lexical.op13_lexical,
}

ORACLE_SQL = {
    "op1_warc": warc.ORACLE,
    "op2_near_dedup": near_dedup.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op11_line_dedup": line_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_lexical": lexical.ORACLE,
}
