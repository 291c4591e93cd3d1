"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tessera.llm.bm25 import op10_bm25_search
from tessera.llm.conversation_trie import op13_conversation_trie, trie_sql
from tessera.llm.decontaminate import op8_decontamination
from tessera.llm.divergence import divergence_sql, op12_source_divergence
from tessera.llm.html_extract import op5_html_extraction
from tessera.llm.language_id import op6_language_id
from tessera.llm.license_scan import license_sql, op1_license_scan
from tessera.llm.lm_score import op7_lm_scoring
from tessera.llm.mixing import op4_mixing
from tessera.llm.near_dedup import op9_near_dedup
from tessera.llm.secret_scan import op3_secret_scan
from tessera.llm.sharding import op2_sharding
from tessera.llm.token_counts import op11_token_counts

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_sharding": op2_sharding,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing": op4_mixing,
    "op5_html_extraction": op5_html_extraction,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_decontamination": op8_decontamination,
    "op9_near_dedup": op9_near_dedup,
    "op10_bm25_search": op10_bm25_search,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_conversation_trie": op13_conversation_trie,
}


def pipeline(spark, sf_dir):
    """The whole corpus pipeline (corpus_pipeline.py at the top of the repository)."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
ORACLE = {"op1_license_scan": license_sql(), "op12_source_divergence": divergence_sql(),
          "op13_conversation_trie": trie_sql()}
