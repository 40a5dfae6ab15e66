"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.alignment import op11_alignment
from tideline.llm.decontaminate import op4_decontamination
from tideline.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from tideline.llm.language import op8_language
from tideline.llm.near_dedup import OP5_SQL, op5_near_dedup
from tideline.llm.negatives import OP13_SQL, op13_hard_negatives
from tideline.llm.pages import op7_html
from tideline.llm.pieces import op6_sentencepiece
from tideline.llm.repeats import op3_repeats
from tideline.llm.secrets import op10_secrets
from tideline.llm.token_counts import op12_token_counts
from tideline.llm.toxicity import op2_toxicity
from tideline.llm.urls import op9_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_repeats": op3_repeats,
    "op4_decontamination": op4_decontamination,
    "op5_near_dedup": op5_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_html": op7_html,
    "op8_language": op8_language,
    "op9_url_filter": op9_url_filter,
    "op10_secrets": op10_secrets,
    "op11_alignment": op11_alignment,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op5_near_dedup": OP5_SQL,
    "op13_hard_negatives": OP13_SQL,
}
