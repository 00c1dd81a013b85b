"""Every query of this subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pintime.llm.byte_bpe import op8_byte_bpe
from pintime.llm.chat import op9_chat
from pintime.llm.collocations import op11_collocations
from pintime.llm.html_extract import op5_html
from pintime.llm.language_id import op10_language_id
from pintime.llm.merge_rounds import op12_merge_rounds
from pintime.llm.near_dedup import op6_near_dedup
from pintime.llm.oracle import ORACLE_SQL
from pintime.llm.packing import op1_packing
from pintime.llm.personal_data import op7_personal_data
from pintime.llm.quality import op3_quality
from pintime.llm.token_counts import op2_token_counts
from pintime.llm.topk_search import op4_topk_search
from pintime.llm.whitening import op13_whitening

QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_counts": op2_token_counts,
    "op3_quality": op3_quality,
    "op4_topk_search": op4_topk_search,
    "op5_html": op5_html,
    "op6_near_dedup": op6_near_dedup,
    "op7_personal_data": op7_personal_data,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_chat": op9_chat,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_merge_rounds": op12_merge_rounds,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
