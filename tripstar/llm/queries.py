"""Registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstar.llm.hard_negatives import op11_hard_negatives
from tripstar.llm.language import op5_language_id
from tripstar.llm.lexical import op13_lexical_search
from tripstar.llm.line_dedup import op10_line_dedup
from tripstar.llm.line_quality import op4_line_quality
from tripstar.llm.mixing import op2_mix_sources
from tripstar.llm.nearest import op7_nearest_neighbours
from tripstar.llm.ngram_join import op8_ngram_jaccard_join
from tripstar.llm.oracle import CHECKS
from tripstar.llm.packing import op6_best_fit_packing
from tripstar.llm.pii import op1_personal_data
from tripstar.llm.token_files import op12_token_files
from tripstar.llm.token_rollups import op9_token_rollups
from tripstar.llm.toxicity import op3_toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_mix_sources,
        op3_toxicity,
        op4_line_quality,
        op5_language_id,
        op6_best_fit_packing,
        op7_nearest_neighbours,
        op8_ngram_jaccard_join,
        op9_token_rollups,
        op10_line_dedup,
        op11_hard_negatives,
        op12_token_files,
        op13_lexical_search,
    )
}

__all__ = ["CHECKS", "QUERIES"]
