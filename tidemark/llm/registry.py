"""The operators as registered queries, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.chat import op7_chat_formatting
from tidemark.llm.decontamination import ORACLE_OP10, op10_decontamination
from tidemark.llm.extraction import op2_html_extraction
from tidemark.llm.fingerprints import op4_fingerprints
from tidemark.llm.manifest import ORACLE_OP13, op13_merkle_manifest
from tidemark.llm.packing import op9_packing
from tidemark.llm.quality import op3_quality
from tidemark.llm.sharding import op6_sharding
from tidemark.llm.simhash import op5_simhash_dedup
from tidemark.llm.spelling import op11_spelling_variants
from tidemark.llm.substrings import ORACLE_OP8, op8_substring_dedup
from tidemark.llm.toxicity import op1_toxicity
from tidemark.llm.warc import ORACLE_OP12, op12_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_html_extraction, op3_quality, op4_fingerprints, op5_simhash_dedup, op6_sharding, op7_chat_formatting,
        op8_substring_dedup, op9_packing, op10_decontamination, op11_spelling_variants, op12_warc,
        op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op8_substring_dedup": ORACLE_OP8, "op10_decontamination": ORACLE_OP10, "op12_warc": ORACLE_OP12,
    "op13_merkle_manifest": ORACLE_OP13,
}
