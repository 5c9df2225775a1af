"""The registered queries of this subpackage and the SQL that gives their rows."""

from __future__ import annotations

from layoutlake.llm import byte_bpe, html_text, id_pack, line_runs, mixing, mpeg_audio, near_dup, quality, repeats, top_k

QUERIES = {
    "op1_byte_bpe": byte_bpe.query,
    "op2_html_text": html_text.query,
    "op3_quality": quality.query,
    "op4_mpeg_audio": mpeg_audio.query,
    "op5_mixing": mixing.query,
    "op6_near_dup": near_dup.query,
    "op7_top_k": top_k.query,
    "op8_id_pack": id_pack.query,
    "op9_line_runs": line_runs.query,
    "op10_repeats": repeats.query,
}

ORACLE_SQL: dict[str, str] = {
    "op9_line_runs": line_runs.ORACLE_SQL,
}
