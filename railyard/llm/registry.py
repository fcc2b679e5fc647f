"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline
from railyard.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from railyard.llm.importance_sampling import OP12_SQL, op12_importance_sampling
from railyard.llm.jaccard_join import OP9_SQL, op9_jaccard_join
from railyard.llm.language_id import op2_language_id
from railyard.llm.license_scan import op6_license_scan
from railyard.llm.line_dedup import OP3_SQL, op3_line_dedup
from railyard.llm.log_bilinear import op10_lm_scoring
from railyard.llm.packing import op4_packing
from railyard.llm.pii import op5_pii
from railyard.llm.quality_rules import op1_quality_rules
from railyard.llm.sentence_pieces import op7_sentence_pieces
from railyard.llm.url_filter import OP11_SQL, op11_url_filter
from railyard.llm.whitening import op13_whitening

LLM_QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_pii": op5_pii,
    "op6_license_scan": op6_license_scan,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_url_filter": op11_url_filter,
    "op12_importance_sampling": op12_importance_sampling,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLE_SQL = {
    "op3_line_dedup": OP3_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_url_filter": OP11_SQL,
    "op12_importance_sampling": OP12_SQL,
}
