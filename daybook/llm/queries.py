"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from daybook.llm import (byte_bpe, chat_pairs, chunk_recipes, hard_negatives, host_quality, language_id, license_scan, line_chunks, near_dup,
                         sketch_diff, source_mix, spelling, token_files)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_token_files": token_files.op2_token_files,
    "op3_source_mix": source_mix.op3_source_mix,
    "op4_language_id": language_id.op4_language_id,
    "op5_sketch_diff": sketch_diff.op5_sketch_diff,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op7_chat_pairs": chat_pairs.op7_chat_pairs,
    "op8_line_chunks": line_chunks.op8_line_chunks,
    "op9_near_dup": near_dup.op9_near_dup,
    "op10_host_quality": host_quality.op10_host_quality,
    "op11_spelling": spelling.op11_spelling,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_chunk_recipes": chunk_recipes.op13_chunk_recipes,
}

# The others are tested against brute force, round trips or held-out rows.
ORACLE = {
    "op1_license_scan": license_scan.ORACLE,
    "op3_source_mix": source_mix.ORACLE,
    "op7_chat_pairs": chat_pairs.ORACLE,
    "op8_line_chunks": line_chunks.ORACLE,
    "op10_host_quality": host_quality.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_chunk_recipes": chunk_recipes.ORACLE,
}
