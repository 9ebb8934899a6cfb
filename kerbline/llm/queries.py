"""The queries of this package by name, and SQL texts for those that SQL can express."""

from __future__ import annotations

from kerbline.llm.bytepairs import op12_byte_pair_encoding
from kerbline.llm.contamination import OP2_SQL, op2_benchmark_decontamination
from kerbline.llm.language import op3_language_id
from kerbline.llm.neardup import OP6_SQL, op6_minhash_near_dedup
from kerbline.llm.negatives import OP13_SQL, op13_hard_negatives
from kerbline.llm.periodic import op11_periodic_runs
from kerbline.llm.pieces import op8_sentencepiece
from kerbline.llm.sharding import op5_virtual_slot_sharding
from kerbline.llm.substrings import OP1_SQL, op1_substring_dedup
from kerbline.llm.suffixes import OP10_SQL, op10_suffix_array_dedup
from kerbline.llm.tokenfiles import op4_token_files
from kerbline.llm.warc import OP7_SQL, op7_warc
from kerbline.llm.winnowing import op9_winnowing

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_virtual_slot_sharding": op5_virtual_slot_sharding,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_warc": op7_warc,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_winnowing": op9_winnowing,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_pair_encoding": op12_byte_pair_encoding,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op2_benchmark_decontamination": OP2_SQL,
    "op6_minhash_near_dedup": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op10_suffix_array_dedup": OP10_SQL,
    "op13_hard_negatives": OP13_SQL,
}
