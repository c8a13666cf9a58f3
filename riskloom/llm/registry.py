"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from riskloom.llm import bpe, brown, decontaminate, jaccard, mixing, periods, repeats, sharding, toolcalls, topk, toxicity, trie, warc

QUERIES = {
    "op1_brown_class_scores": brown.op1_brown_class_scores,
    "op2_exact_top_k": topk.op2_exact_top_k,
    "op3_lsh_forest_join": jaccard.op3_lsh_forest_join,
    "op4_warc_salvage": warc.op4_warc_salvage,
    "op5_template_decontamination": decontaminate.op5_template_decontamination,
    "op6_link_tool_calls": toolcalls.op6_link_tool_calls,
    "op7_string_kernel_toxicity": toxicity.op7_string_kernel_toxicity,
    "op8_rendezvous_shards": sharding.op8_rendezvous_shards,
    "op9_fm_index_repeats": repeats.op9_fm_index_repeats,
    "op10_golden_ratio_mix": mixing.op10_golden_ratio_mix,
    "op11_periodic_runs": periods.op11_periodic_runs,
    "op12_byte_level_bpe": bpe.op12_byte_level_bpe,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLE = {
    "op2_exact_top_k": topk.ORACLE,
    "op4_warc_salvage": warc.ORACLE,
    "op8_rendezvous_shards": sharding.ORACLE,
    "op9_fm_index_repeats": repeats.ORACLE,
    "op10_golden_ratio_mix": mixing.ORACLE,
    "op11_periodic_runs": periods.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
}
