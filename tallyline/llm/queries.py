"""The queries of this subpackage and, where SQL can express one, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm.compression_quality import op3_compression_quality
from tallyline.llm.decontaminate import op6_decontaminate
from tallyline.llm.disclosure import op8_disclosure
from tallyline.llm.language_model import op4_gru_language_model
from tallyline.llm.line_chunks import op10_line_chunks
from tallyline.llm.merkle_manifest import op11_merkle_manifest
from tallyline.llm.minmax_dedup import op2_minmax_dedup
from tallyline.llm.oracles import ORACLES  # noqa: F401 - part of this module's interface
from tallyline.llm.periodic_runs import op13_periodic_runs
from tallyline.llm.pieces import op1_sentencepiece
from tallyline.llm.quality_rules import op9_quality_rules
from tallyline.llm.substring_dedup import op12_substring_dedup
from tallyline.llm.token_counts import op7_token_counts
from tallyline.llm.token_files import op5_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_minmax_dedup": op2_minmax_dedup,
    "op3_compression_quality": op3_compression_quality,
    "op4_gru_language_model": op4_gru_language_model,
    "op5_token_files": op5_token_files,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_counts": op7_token_counts,
    "op8_disclosure": op8_disclosure,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_chunks": op10_line_chunks,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
