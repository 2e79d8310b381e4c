"""The queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tractlake.llm import byte_bpe, embedding_dedup, filter_audit, jaccard, language, line_dedup, lm_scoring, packing, prefix_trie, quality, suffix_dedup, topk, toxicity

MODULES = (line_dedup, packing, toxicity, byte_bpe, topk, jaccard, language, suffix_dedup, quality, lm_scoring, prefix_trie, embedding_dedup, filter_audit)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
