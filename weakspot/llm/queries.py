"""Queries over whole tables, one per operator, and their checks in SQL."""

from __future__ import annotations

from weakspot.llm.decontamination import OP7_SQL, op7_decontamination
from weakspot.llm.divergence import OP12_SQL, op12_source_divergence
from weakspot.llm.embedding_near_dup import op4_embedding_near_dup
from weakspot.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from weakspot.llm.html_extraction import op11_html_extraction
from weakspot.llm.jaccard_join import op10_jaccard_join
from weakspot.llm.language_id import op9_language_id
from weakspot.llm.license_scan import OP8_SQL, op8_license_scan
from weakspot.llm.line_dedup import OP3_SQL, op3_line_dedup
from weakspot.llm.mixing import op2_mixing
from weakspot.llm.quality_classifier import op5_quality_classifier
from weakspot.llm.secret_scan import op6_secret_scan
from weakspot.llm.token_counts import op1_token_counts

QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_mixing, op3_line_dedup, op4_embedding_near_dup, op5_quality_classifier, op6_secret_scan,
              op7_decontamination, op8_license_scan, op9_language_id, op10_jaccard_join,
              op11_html_extraction, op12_source_divergence, op13_fill_in_middle)
}
CHECKS: dict[str, str] = {
    "op3_line_dedup": OP3_SQL, "op7_decontamination": OP7_SQL, "op8_license_scan": OP8_SQL,
    "op12_source_divergence": OP12_SQL, "op13_fill_in_middle": OP13_SQL,
}
