"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from graphloom.llm import byte_bpe, chat, gated_lm, imatch, line_dedup, packing, phrases, quality_rules, rule_ensemble, secrets, simhash, url_rules, whitening

QUERIES = {
    "op1_byte_bpe": byte_bpe.query,
    "op2_secret_scans": secrets.query,
    "op3_best_fit_packing": packing.query,
    "op4_line_dedup": line_dedup.query,
    "op5_chat_formatting": chat.query,
    "op6_quality_rules": quality_rules.query,
    "op7_quality_classifier": rule_ensemble.query,
    "op8_url_filters": url_rules.query,
    "op9_simhash_near_dedup": simhash.query,
    "op10_document_fingerprints": imatch.query,
    "op11_lm_scoring": gated_lm.query,
    "op12_embedding_whitening": whitening.query,
    "op13_phrase_collocations": phrases.query,
}
ORACLE: dict[str, str] = {
    "op5_chat_formatting": chat.SQL,
    "op8_url_filters": url_rules.SQL,
    "op13_phrase_collocations": phrases.SQL,
}
