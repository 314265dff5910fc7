"""Registered queries of the operators and the pipeline, with oracle SQL where SQL can say it."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run

from .audit import OP11_SQL, op11_filter_audit
from .bpe import op12_token_counts
from .fim import OP13_SQL, op13_fill_in_middle
from .jaccard import op10_jaccard_join
from .licenses import op7_license_scan
from .linededup import op4_line_dedup
from .mixing import OP9_SQL, op9_mixing
from .packing import op8_packing
from .quality import op3_quality_rules
from .records import op1_token_records
from .secrets import op5_secret_scan
from .topk import OP2_SQL, op2_exact_top_k
from .toxicity import op6_toxicity

QUERIES = {
    "op1_token_records": op1_token_records,
    "op8_packing": op8_packing,
    "op10_jaccard_join": op10_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op2_exact_top_k": op2_exact_top_k,
    "op9_mixing": op9_mixing,
    "op6_toxicity": op6_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op4_line_dedup": op4_line_dedup,
    "op7_license_scan": op7_license_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_counts": op12_token_counts,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": run,
}

ORACLES: dict[str, str] = {
    "op2_exact_top_k": OP2_SQL,
    "op9_mixing": OP9_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
if ORACLE_SQL is not None:
    ORACLES["pipeline"] = ORACLE_SQL
