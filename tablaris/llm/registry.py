"""The registered queries of these operators and their SQL."""

from __future__ import annotations

from tablaris.llm import bpe, chat, embedding_dedup, exact_dedup, language, line_dedup, ngram_join, packing, periodic_runs, quality, secrets, spelling, suffix_dedup

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_language_id": language.op3_language_id,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_chat_format": chat.op6_chat_format,
    "op7_ngram_jaccard_join": ngram_join.op7_ngram_jaccard_join,
    "op8_packing": packing.op8_packing,
    "op9_embedding_near_dup": embedding_dedup.op9_embedding_near_dup,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_quality_classifier": quality.op11_quality_classifier,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLES = {
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op5_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_chat_format": chat.ORACLE_SQL,
    "op12_spelling_variants": spelling.ORACLE_SQL,
    "op13_periodic_runs": periodic_runs.ORACLE_SQL,
}
