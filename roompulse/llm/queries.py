"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from roompulse.llm.alignment import op11_cross_tokenizer_alignment
from roompulse.llm.chat import OP3_SQL, op3_chat_formatting
from roompulse.llm.decontaminate import OP8_SQL, op8_benchmark_decontamination
from roompulse.llm.group_packing import op13_packing
from roompulse.llm.infill import OP12_SQL, op12_fill_in_middle
from roompulse.llm.language import op6_language_id
from roompulse.llm.lines import OP7_SQL, op7_line_dedup
from roompulse.llm.minhash import op5_minhash_near_dedup
from roompulse.llm.neighbours import op10_nearest_neighbours
from roompulse.llm.packing import op4_best_fit_packing
from roompulse.llm.suffix_dedup import op2_suffix_array_dedup
from roompulse.llm.token_counts import op1_token_counts
from roompulse.llm.token_files import op9_token_files

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_files": op9_token_files,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_packing": op13_packing,
}

ORACLE = {
    "op3_chat_formatting": OP3_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
