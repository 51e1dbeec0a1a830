"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from .exact_dedup import OP3_SQL, op3_exact_dedup
from .html_text import op7_html_text
from .line_dedup import OP1_SQL, op1_line_dedup
from .mixing import op5_mixing
from .nearest import op13_nearest
from .packing import op6_packing
from .periodic_runs import op11_periodic_runs
from .sharding import op8_sharding
from .simhash import op10_simhash
from .token_counts import op2_token_counts
from .toxicity import op4_toxicity
from .whitening import op12_whitening
from .winnowing import op9_winnowing

QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_token_counts, op3_exact_dedup, op4_toxicity, op5_mixing, op6_packing,
    op7_html_text, op8_sharding, op9_winnowing, op10_simhash,
    op11_periodic_runs, op12_whitening, op13_nearest)}

ORACLE_SQL = {"op1_line_dedup": OP1_SQL, "op3_exact_dedup": OP3_SQL}
