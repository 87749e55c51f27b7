"""Queries and DuckDB SQL of this subpackage."""

from __future__ import annotations

from panelkit.llm.best_fit_packing import op7_best_fit_packing
from panelkit.llm.decontamination import op10_decontamination
from panelkit.llm.hard_negatives import op12_hard_negatives
from panelkit.llm.line_dedup import op8_line_dedup
from panelkit.llm.oracles import OP5_SQL, OP6_SQL, OP8_SQL
from panelkit.llm.periodic_runs import op11_periodic_runs
from panelkit.llm.quality_classifier import op13_quality_classifier
from panelkit.llm.quality_rules import OP1_SQL, op1_quality_rules
from panelkit.llm.secret_scan import op6_secret_scan
from panelkit.llm.simhash_dedup import op2_simhash_dedup
from panelkit.llm.substring_dedup import op5_substring_dedup
from panelkit.llm.suffix_dedup import op4_suffix_dedup
from panelkit.llm.token_counts import op3_token_counts
from panelkit.llm.url_filter import op9_url_filter

QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_simhash_dedup, op3_token_counts, op4_suffix_dedup, op5_substring_dedup, op6_secret_scan,
    op7_best_fit_packing, op8_line_dedup, op9_url_filter, op10_decontamination, op11_periodic_runs,
    op12_hard_negatives, op13_quality_classifier)}

#: The others hash, tokenise or train in ways that SQL cannot express; tests hold them against brute force.
ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_secret_scan": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
}
