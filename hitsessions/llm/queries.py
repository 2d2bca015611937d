"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from . import (bpe, decontaminate, hard_negatives, lexical_search, line_dedup, ngram_join, pii, quality_classifier, quality_rules,
               substring_dedup, suffix_dedup, token_counts, url_filter)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_quality_rules": quality_rules.query,
    "op3_ngram_join": ngram_join.query,
    "op4_pii": pii.query,
    "op5_quality_classifier": quality_classifier.query,
    "op6_token_counts": token_counts.query,
    "op7_bpe": bpe.query,
    "op8_decontamination": decontaminate.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_lexical_search": lexical_search.query,
    "op12_url_filter": url_filter.query,
    "op13_hard_negatives": hard_negatives.query,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op10_suffix_dedup": suffix_dedup.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_url_filter": url_filter.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
