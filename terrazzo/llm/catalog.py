"""The numbered queries of this subpackage and, where SQL can say them, their SQL twins."""

from terrazzo.llm import chat, decontam, grammar, langid, manifest, mixing, neardup, sharding, substrings, topk, urls, vecdup, vectorcodes

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_near_dedup": neardup.op2_near_dedup,
    "op3_chat": chat.op3_chat,
    "op4_exact_topk": topk.op4_exact_topk,
    "op5_language_id": langid.op5_language_id,
    "op6_token_ids": grammar.op6_token_ids,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_suffix_dedup": substrings.op8_suffix_dedup,
    "op9_sharding": sharding.op9_sharding,
    "op10_url_filters": urls.op10_url_filters,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_embedding_dedup": vecdup.op12_embedding_dedup,
    "op13_vector_codes": vectorcodes.op13_vector_codes,
}

SQL = {
    "op3_chat": chat.OP3_SQL,
    "op4_exact_topk": topk.OP4_SQL,
    "op7_decontamination": decontam.OP7_SQL,
    "op11_merkle_manifest": manifest.OP11_SQL,
    "op12_embedding_dedup": vecdup.OP12_SQL,
    "op13_vector_codes": vectorcodes.OP13_SQL,
}
