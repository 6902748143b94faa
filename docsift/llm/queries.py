"""Registered queries of the training-data operators and their oracle SQL."""

from docsift.llm import ann, bpe, collocations, language, mixing, packing, pieces, ranked, secret_scan, simhash, suffix_dedup, topk, toxicity

QUERIES = {
    "op1_packed_ids": packing.op1,
    "op2_suffix_dedup": suffix_dedup.op2,
    "op3_mix_sources": mixing.op3,
    "op4_byte_bpe": bpe.op4,
    "op5_language_id": language.op5,
    "op6_secret_scan": secret_scan.op6,
    "op7_toxicity": toxicity.op7,
    "op8_topk_inner_product": topk.op8,
    "op9_ann_int8_tiles": ann.op9,
    "op10_simhash_near_dedup": simhash.op10,
    "op11_sentencepiece": pieces.op11,
    "op12_ranked_search": ranked.op12,
    "op13_collocations": collocations.op13,
}

# The others are not expressible in SQL (hash functions, trained models, byte-pair merges); tests hold them against brute force.
SQL = {
    "op13_collocations": collocations.OP13_SQL,
    "op12_ranked_search": ranked.OP12_SQL,
    "op2_suffix_dedup": suffix_dedup.OP2_SQL,
    "op3_mix_sources": mixing.OP3_SQL,
    "op6_secret_scan": secret_scan.OP6_SQL,
    "op8_topk_inner_product": topk.OP8_SQL,
    "op9_ann_int8_tiles": ann.OP9_SQL,
}
