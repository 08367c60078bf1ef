"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from brook.llm.decontaminate import OP3_SQL, op3_benchmark_decontamination
from brook.llm.filter_audit import OP13_SQL, op13_filter_audit
from brook.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from brook.llm.html_text import op4_html_extraction
from brook.llm.language import op6_language_id
from brook.llm.licenses import op9_license_scans
from brook.llm.line_dedup import op8_line_dedup
from brook.llm.near_dedup import op7_minhash_near_dedup
from brook.llm.pieces import op5_sentencepiece
from brook.llm.token_files import op11_token_files
from brook.llm.topk import OP10_SQL, op10_exact_top_k
from brook.llm.toxicity import op2_toxicity
from brook.llm.url_filter import OP1_SQL, op1_url_filters

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_license_scans": op9_license_scans,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_token_files": op11_token_files,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op1_url_filters": OP1_SQL,
    "op3_benchmark_decontamination": OP3_SQL,
    "op10_exact_top_k": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
