"""The corpus operators' queries and their SQL, by the names that __spark_entry__ registers."""

from __future__ import annotations

from helixframe.llm import language_id, media, mixing, ngram_join, packing, quality_classifier, quality_rules, secrets, tokens, toxicity

QUERIES = {
    "op1_ngram_join": ngram_join.query,
    "op2_language_id": language_id.query,
    "op3_mix_sources": mixing.query,
    "op4_media_columns": media.query,
    "op5_toxicity": toxicity.query,
    "op6_quality_rules": quality_rules.query,
    "op7_quality_classifier": quality_classifier.query,
    "op8_secret_scan": secrets.query,
    "op9_best_fit_packing": packing.query,
    "op10_token_output": tokens.query,
}

SQL = {
    "op3_mix_sources": mixing.SQL,
}
