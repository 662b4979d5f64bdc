"""The operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from fareloom.llm.bpe_counts import op5_bpe_heap_counts
from fareloom.llm.credentials import op2_credential_links
from fareloom.llm.decontaminate import LEAK_SQL, op6_suffix_automaton
from fareloom.llm.fill_in_middle import FIM_SQL, op12_indexable_skip_list
from fareloom.llm.lattice_lm import op1_subword_lattice
from fareloom.llm.mixing import op9_systematic_mix
from fareloom.llm.near_dedup import NEAR_SQL, op7_minmax_hash
from fareloom.llm.packing import op11_grouping_genetic
from fareloom.llm.perspectives import PERSPECTIVE_SQL, op10_perspective_rotation
from fareloom.llm.prefix_trie import TRIE_SQL, op13_centroid_rollup
from fareloom.llm.quality import QUALITY_SQL, op3_adaptive_quality
from fareloom.llm.url_filter import URL_SQL, op4_digest_array
from fareloom.llm.warc import WARC_SQL, op8_warc_dictionary

QUERIES = {
    f.__name__: f
    for f in (
        op1_subword_lattice,
        op2_credential_links,
        op3_adaptive_quality,
        op4_digest_array,
        op5_bpe_heap_counts,
        op6_suffix_automaton,
        op7_minmax_hash,
        op8_warc_dictionary,
        op9_systematic_mix,
        op10_perspective_rotation,
        op11_grouping_genetic,
        op12_indexable_skip_list,
        op13_centroid_rollup,
    )
}

ORACLES = {
    "op3_adaptive_quality": QUALITY_SQL,
    "op4_digest_array": URL_SQL,
    "op6_suffix_automaton": LEAK_SQL,
    "op7_minmax_hash": NEAR_SQL,
    "op8_warc_dictionary": WARC_SQL,
    "op10_perspective_rotation": PERSPECTIVE_SQL,
    "op12_indexable_skip_list": FIM_SQL,
    "op13_centroid_rollup": TRIE_SQL,
}
