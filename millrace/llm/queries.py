"""Registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from millrace.llm import bpe, exact_dedup, fingerprints, hmm, language, line_templates, near_dedup, packing, ranked_search, shards, simhash, url_rules, vector_codes

QUERIES = {
    "op1_url_filters": url_rules.op1_url_filters,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_hmm_scoring": hmm.op3_hmm_scoring,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_line_templates": line_templates.op5_line_templates,
    "op6_sharding": shards.op6_sharding,
    "op7_minhash_fingerprints": fingerprints.op7_minhash_fingerprints,
    "op8_language_id": language.op8_language_id,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_simhash_near_dedup": simhash.op13_simhash_near_dedup,
}

ORACLES = {
    "op1_url_filters": url_rules.OP1_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_line_templates": line_templates.OP5_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
