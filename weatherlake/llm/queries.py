"""The registered queries of this package and their SQL, by name."""

from __future__ import annotations

from weatherlake.llm import contamination, extraction, language, licences, lines, near_dups, neighbours, pieces, quality, reputation, sharding, spelling, whitening

QUERIES = {
    "op1_main_text": extraction.op1_main_text,
    "op2_contamination": contamination.op2_contamination,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_language": language.op4_language,
    "op5_sharding": sharding.op5_sharding,
    "op6_quality": quality.op6_quality,
    "op7_near_dups": near_dups.op7_near_dups,
    "op8_neighbours": neighbours.op8_neighbours,
    "op9_pieces": pieces.op9_pieces,
    "op10_licences": licences.op10_licences,
    "op11_reputation": reputation.op11_reputation,
    "op12_whitening": whitening.op12_whitening,
    "op13_variants": spelling.op13_variants,
}

SQL = {
    "op7_near_dups": near_dups.SQL,
    "op8_neighbours": neighbours.SQL,
    "op11_reputation": reputation.SQL,
}
