"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from groundmill.llm import additive_search, chat, licences, mixing, near_dedup, packing, pieces, range_join, ranked_search, substring_dedup, suffix_dedup, toxicity, whitening


def queries():
    return {
        "pipeline": corpus_pipeline.run,
        "op1_license_scan": licences.op1_license_scan,
        "op2_minhash_near_dedup": near_dedup.op2_minhash_near_dedup,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_chat_format": chat.op4_chat_format,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_additive_search": additive_search.op6_additive_search,
        "op7_sentencepiece": pieces.op7_sentencepiece,
        "op8_mixing": mixing.op8_mixing,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_embedding_near_dedup": range_join.op10_embedding_near_dedup,
        "op11_whitening": whitening.op11_whitening,
        "op12_packing": packing.op12_packing,
        "op13_ranked_search": ranked_search.op13_ranked_search,
    }


def oracle_sql():
    return {"op2_minhash_near_dedup": near_dedup.OP2_SQL, "op4_chat_format": chat.OP4_SQL, "op8_mixing": mixing.OP8_SQL, "op9_substring_dedup": substring_dedup.OP9_SQL, "op10_embedding_near_dedup": range_join.OP10_SQL, "op13_ranked_search": ranked_search.OP13_SQL}
