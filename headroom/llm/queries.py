"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .credentials import op1_secret_scans
from .licences import op5_license_scans
from .licences import oracle_sql as license_sql
from .lm import op6_lm_scoring
from .media import op8_media_chunking
from .mixing import op3_source_mixing
from .negatives import op12_hard_negatives
from .negatives import oracle_sql as negatives_sql
from .packing import op10_best_fit_packing
from .purity import op4_pu_quality
from .rules import op7_quality_rules
from .sharding import op9_kd_tree_sharding
from .simhash import op2_simhash_near_dedup
from .turntrie import op13_conversation_prefix_trie
from .turntrie import oracle_sql as turntrie_sql
from .webpages import op11_html_extraction

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_source_mixing": op3_source_mixing,
        "op4_pu_quality": op4_pu_quality,
        "op5_license_scans": op5_license_scans,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_quality_rules": op7_quality_rules,
        "op8_media_chunking": op8_media_chunking,
        "op9_kd_tree_sharding": op9_kd_tree_sharding,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_html_extraction": op11_html_extraction,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the license scan, the negatives and the conversations. The other methods (learned models, traversals, hashes that SQL lacks, packings) can't be
    written as SQL; tests hold them against brute force."""
    return {"op5_license_scans": license_sql(), "op12_hard_negatives": negatives_sql(), "op13_conversation_prefix_trie": turntrie_sql()}
