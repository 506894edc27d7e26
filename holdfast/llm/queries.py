"""Registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm.ann import op10_ann_forest
from holdfast.llm.html import op7_html_extraction
from holdfast.llm.infill import OP13_SQL, op13_fill_in_middle
from holdfast.llm.langid import op2_language_id
from holdfast.llm.merkle import OP12_SQL, op12_merkle_manifest
from holdfast.llm.minhash import OP3_SQL, op3_minhash_dedup
from holdfast.llm.mixing import op1_source_mixing
from holdfast.llm.packing import op9_best_fit_packing
from holdfast.llm.passages import op4_substring_dedup
from holdfast.llm.suffixes import OP11_SQL, op11_suffix_array_dedup
from holdfast.llm.topk import OP5_SQL, op5_exact_top_k
from holdfast.llm.toxicity import op8_toxicity
from holdfast.llm.warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mixing,
        op2_language_id,
        op3_minhash_dedup,
        op4_substring_dedup,
        op5_exact_top_k,
        op6_warc,
        op7_html_extraction,
        op8_toxicity,
        op9_best_fit_packing,
        op10_ann_forest,
        op11_suffix_array_dedup,
        op12_merkle_manifest,
        op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = {
    "op3_minhash_dedup": OP3_SQL,
    "op5_exact_top_k": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op11_suffix_array_dedup": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
