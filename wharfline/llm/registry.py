"""Queries of this folder and the SQL they are checked against."""

from __future__ import annotations

from . import (
    byte_bpe,
    decontaminate,
    graph_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    suffix_dedup,
    toxicity,
    url_templates,
    warc,
)

QUERIES = {
    "op1_graph_dedup": graph_dedup.op1_graph_dedup,
    "op2_url_templates": url_templates.op2_url_templates,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_warc_chunks": warc.op4_warc_chunks,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_language_id": language_id.op6_language_id,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_lexical_packing": packing.op8_lexical_packing,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_line_chunks": line_dedup.op10_line_chunks,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_byte_bpe": byte_bpe.op12_byte_bpe,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE_SQL = {
    "op1_graph_dedup": graph_dedup.oracle(),
    "op2_url_templates": url_templates.oracle(),
    "op3_ngram_join": ngram_join.oracle(),
    "op4_warc_chunks": warc.oracle(),
    "op9_decontaminate": decontaminate.oracle(),
    "op10_line_chunks": line_dedup.oracle(),
    "op11_hard_negatives": hard_negatives.oracle(),
    "op13_merkle_manifest": merkle.oracle(),
}
