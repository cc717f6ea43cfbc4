"""Queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

import corpus_pipeline
from farebox.llm.conversation_trie import ORACLE as TRIE_SQL
from farebox.llm.conversation_trie import op12_conversation_trie
from farebox.llm.filter_audit import ORACLE as AUDIT_SQL
from farebox.llm.filter_audit import op13_filter_audit
from farebox.llm.fingerprints import op11_fingerprints
from farebox.llm.language_id import op5_language_id
from farebox.llm.line_quality import op4_line_quality
from farebox.llm.mixing import ORACLE as MIXING_SQL
from farebox.llm.mixing import op9_mixing
from farebox.llm.packing import op10_packing
from farebox.llm.quality_rules import op2_quality_rules
from farebox.llm.simhash import op7_simhash_near_dedup
from farebox.llm.suffix_dedup import ORACLE as SUFFIX_SQL
from farebox.llm.suffix_dedup import op1_suffix_dedup
from farebox.llm.token_counts import op3_token_counts
from farebox.llm.topk import ORACLE as TOPK_SQL
from farebox.llm.topk import op6_exact_topk
from farebox.llm.toxicity import op8_toxicity

_QUERIES = (
    op1_suffix_dedup,
    op2_quality_rules,
    op3_token_counts,
    op4_line_quality,
    op5_language_id,
    op6_exact_topk,
    op7_simhash_near_dedup,
    op8_toxicity,
    op9_mixing,
    op10_packing,
    op11_fingerprints,
    op12_conversation_trie,
    op13_filter_audit,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": SUFFIX_SQL,
        "op6_exact_topk": TOPK_SQL,
        "op9_mixing": MIXING_SQL,
        "op12_conversation_trie": TRIE_SQL,
        "op13_filter_audit": AUDIT_SQL,
    }
