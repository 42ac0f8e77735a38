"""Registered queries of the training-data operators, and the SQL of those SQL can state."""

from . import (decontam, html, langid, mixing, negatives, quality, rules, sharding, simhash, suffix, tokens, toxicity,
               whitening)

QUERIES = {
    "op1_mix_sources": mixing.op1_query,
    "op2_token_counts": tokens.op2_query,
    "op3_quality": quality.op3_query,
    "op4_decontaminate": decontam.op4_query,
    "op5_toxicity": toxicity.op5_query,
    "op6_suffix_dedup": suffix.op6_query,
    "op7_html_text": html.op7_query,
    "op8_sharding": sharding.op8_query,
    "op9_quality_rules": rules.op9_query,
    "op10_simhash": simhash.op10_query,
    "op11_hard_negatives": negatives.op11_query,
    "op12_language": langid.op12_query,
    "op13_whitening": whitening.op13_query,
}

ORACLE = {
    "op1_mix_sources": mixing.ORACLE,
    "op4_decontaminate": decontam.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
}
