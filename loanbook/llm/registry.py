"""Queries of this subpackage by name, and checking SQL where it can be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanbook.llm.cross_polytope import op4_cross_polytope
from loanbook.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from loanbook.llm.language_ppm import op2_language_ppm
from loanbook.llm.line_templates import op5_line_templates
from loanbook.llm.masked_lm import op10_masked_lm
from loanbook.llm.minmax_dedup import op3_minmax_dedup
from loanbook.llm.mixing import OP6_SQL, op6_mixing
from loanbook.llm.packing import op9_packing
from loanbook.llm.phrase_graph import OP11_SQL, op11_phrase_graph
from loanbook.llm.quality_forest import op8_quality_forest
from loanbook.llm.secrets import op1_secret_scan
from loanbook.llm.template_markup import OP12_SQL, op12_template_markup
from loanbook.llm.token_scan import op7_token_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        op1_secret_scan,
        op2_language_ppm,
        op3_minmax_dedup,
        op4_cross_polytope,
        op5_line_templates,
        op6_mixing,
        op7_token_scan,
        op8_quality_forest,
        op9_packing,
        op10_masked_lm,
        op11_phrase_graph,
        op12_template_markup,
        op13_hard_negatives,
    ]
}

ORACLE_SQL: dict[str, str] = {
    "op6_mixing": OP6_SQL,
    "op11_phrase_graph": OP11_SQL,
    "op12_template_markup": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
