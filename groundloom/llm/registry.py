"""Queries of this package: one per operator, the pipeline, and their DuckDB texts."""

from __future__ import annotations

from groundloom.llm.alignment import op11_alignment
from groundloom.llm.blocks import op4_main_text
from groundloom.llm.bpe import op9_bpe
from groundloom.llm.decontam import OP6_SQL, op6_decontamination
from groundloom.llm.fingerprint import op10_fingerprints
from groundloom.llm.language import op1_language
from groundloom.llm.lines import OP12_SQL, op12_line_dedup
from groundloom.llm.neardup import op2_near_duplicates
from groundloom.llm.phrases import OP13_SQL, op13_collocations
from groundloom.llm.quality import op3_quality
from groundloom.llm.secrets import op5_secrets
from groundloom.llm.sharding import OP8_SQL, op8_shards
from groundloom.llm.urls import op7_url_filter

QUERIES = {
    "op1_language": op1_language,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality": op3_quality,
    "op4_main_text": op4_main_text,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_url_filter": op7_url_filter,
    "op8_shards": op8_shards,
    "op9_bpe": op9_bpe,
    "op10_fingerprints": op10_fingerprints,
    "op11_alignment": op11_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
}
ORACLES = {
    "op6_decontamination": OP6_SQL,
    "op8_shards": OP8_SQL,
    "op12_line_dedup": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
