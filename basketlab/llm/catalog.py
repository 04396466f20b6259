"""Registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketlab.llm.byte_bpe import op9_byte_bpe
from basketlab.llm.collocations import op11_collocations
from basketlab.llm.decontaminate import op6_decontamination
from basketlab.llm.importance import op13_importance_resampling
from basketlab.llm.license_scan import op4_license_scan
from basketlab.llm.near_dedup import op1_near_dedup
from basketlab.llm.oracles import ORACLE_SQL  # noqa: F401
from basketlab.llm.packing import op12_packing
from basketlab.llm.quality_gam import op7_quality_gam
from basketlab.llm.quality_rules import op3_quality_rules
from basketlab.llm.quote_links import op2_quote_links
from basketlab.llm.secret_scan import op10_secret_scan
from basketlab.llm.token_files import op8_token_files
from basketlab.llm.warc import op5_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quote_links": op2_quote_links,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_quality_gam": op7_quality_gam,
    "op8_token_files": op8_token_files,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_secret_scan": op10_secret_scan,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_importance_resampling": op13_importance_resampling,
}
