"""Registered queries of the corpus operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pitchside.llm.decontaminate import OP1_SQL, op1_decontaminate
from pitchside.llm.embedding_tiles import OP6_SQL, op6_embedding_tiles
from pitchside.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from pitchside.llm.gru_lm import op8_gru_lm
from pitchside.llm.jaccard_join import OP10_SQL, op10_jaccard_join
from pitchside.llm.license_scan import op2_license_scan
from pitchside.llm.line_dedup import op7_line_dedup
from pitchside.llm.piece_viterbi import op4_piece_viterbi
from pitchside.llm.repeat_removal import OP5_SQL, op5_repeat_removal
from pitchside.llm.token_alignment import op13_token_alignment
from pitchside.llm.token_store import op9_token_store
from pitchside.llm.toxicity import op3_toxicity
from pitchside.llm.url_filter import OP11_SQL, op11_url_filter

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_piece_viterbi": op4_piece_viterbi,
    "op5_repeat_removal": op5_repeat_removal,
    "op6_embedding_tiles": op6_embedding_tiles,
    "op7_line_dedup": op7_line_dedup,
    "op8_gru_lm": op8_gru_lm,
    "op9_token_store": op9_token_store,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_url_filter": op11_url_filter,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL = {"op1_decontaminate": OP1_SQL, "op5_repeat_removal": OP5_SQL,
              "op6_embedding_tiles": OP6_SQL, "op10_jaccard_join": OP10_SQL,
              "op11_url_filter": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
