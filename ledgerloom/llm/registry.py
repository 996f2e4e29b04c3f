"""The subpackage's queries and their SQL."""

from __future__ import annotations

from . import context_mixing, decontamination, fingerprints, html_text, importance, ngram_join, quality, sentencepiece_codec, suffix_dedup, token_output, toxicity, warc, whitening


def queries() -> dict:
    return {
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_warc": warc.op2_warc,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_html_extraction": html_text.op4_html_extraction,
        "op5_fingerprints": fingerprints.op5_fingerprints,
        "op6_ngram_join": ngram_join.op6_ngram_join,
        "op7_token_output": token_output.op7_token_output,
        "op8_sentencepiece": sentencepiece_codec.op8_sentencepiece,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_quality": quality.op10_quality,
        "op11_importance": importance.op11_importance,
        "op12_whitening": whitening.op12_whitening,
        "op13_context_mixing": context_mixing.op13_context_mixing,
    }


def oracle_sql() -> dict[str, str]:
    """Trained operators, the tokenizer's and HTML extraction have none; tests/llm holds brute-force versions."""
    return {
        "op1_decontamination": decontamination.ORACLE_SQL,
        "op2_warc": warc.ORACLE_SQL,
        "op3_suffix_dedup": suffix_dedup.ORACLE_SQL,
        "op6_ngram_join": ngram_join.ORACLE_SQL,
        "op11_importance": importance.ORACLE_SQL,
    }
