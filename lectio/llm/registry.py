"""The queries and SQL of the numbered operators."""

from __future__ import annotations

from lectio.llm import bpe, chat, decontaminate, importance, jaccard, line_dedup, merkle, quality, suffix_dedup, syncmers, token_store, url_reputation, warc

QUERIES = {
    "op1_syncmer_fingerprints": syncmers.op1_syncmer_fingerprints,
    "op2_url_filters": url_reputation.op2_url_filters,
    "op3_token_store": token_store.op3_token_store,
    "op4_bpe": bpe.op4_bpe,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_warc": warc.op11_warc,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_importance": importance.op13_importance,
}
ORACLES = {
    "op2_url_filters": url_reputation.OP2_SQL,
    "op5_decontamination": decontaminate.OP5_SQL,
    "op6_ngram_jaccard": jaccard.OP6_SQL,
    "op9_chat_formatting": chat.OP9_SQL,
    "op11_warc": warc.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
    "op13_importance": importance.OP13_SQL,
}
