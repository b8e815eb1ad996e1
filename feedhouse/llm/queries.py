"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedhouse.llm.ctw import op9_context_tree_weighting
from feedhouse.llm.filter_audit import op12_filter_audit
from feedhouse.llm.heap_clusters import op11_heap_clusters
from feedhouse.llm.order_minhash import op7_order_minhash
from feedhouse.llm.packing import op6_genetic_packing
from feedhouse.llm.pieces import op8_streaming_viterbi
from feedhouse.llm.quality_net import op5_random_indexing_net
from feedhouse.llm.repeats import op3_interval_tree
from feedhouse.llm.rules import op10_quality_rules
from feedhouse.llm.sharding import op1_hash_tree
from feedhouse.llm.spots import op4_spot_fingerprints
from feedhouse.llm.sql import EXACT_TOP_K, FILTER_AUDIT, HEAP_CLUSTERS, QUALITY_RULES
from feedhouse.llm.topk import op13_exact_top_k
from feedhouse.llm.warc import op2_derivative_builder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_tree": op1_hash_tree,
    "op2_derivative_builder": op2_derivative_builder,
    "op3_interval_tree": op3_interval_tree,
    "op4_spot_fingerprints": op4_spot_fingerprints,
    "op5_random_indexing_net": op5_random_indexing_net,
    "op6_genetic_packing": op6_genetic_packing,
    "op7_order_minhash": op7_order_minhash,
    "op8_streaming_viterbi": op8_streaming_viterbi,
    "op9_context_tree_weighting": op9_context_tree_weighting,
    "op10_quality_rules": op10_quality_rules,
    "op11_heap_clusters": op11_heap_clusters,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_top_k": op13_exact_top_k,
}

ORACLE: dict[str, str] = {
    "op10_quality_rules": QUALITY_RULES,
    "op11_heap_clusters": HEAP_CLUSTERS,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_exact_top_k": EXACT_TOP_K,
}
