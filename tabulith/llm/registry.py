"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tabulith.llm import bpe, dac, exact_dedup, filter_audit, html_text, language, lm_score, mixing, quality, secret_scan, simhash, spelling, url_filter


def queries() -> dict:
    return {
        "op1_lm_score": lm_score.op1_lm_score,
        "op2_secret_scan": secret_scan.op2_secret_scan,
        "op3_bpe": bpe.op3_bpe,
        "op4_token_file": dac.op4_token_file,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_mixing": mixing.op7_mixing,
        "op8_language_id": language.op8_language_id,
        "op9_url_filter": url_filter.op9_url_filter,
        "op10_simhash": simhash.op10_simhash,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_html_text": html_text.op12_html_text,
        "op13_filter_audit": filter_audit.op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_dedup": exact_dedup.OP6_SQL,
        "op7_mixing": mixing.OP7_SQL,
        "op9_url_filter": url_filter.OP9_SQL,
        "op13_filter_audit": filter_audit.OP13_SQL,
    }
