"""The numbered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from .byte_bpe import op7_byte_bpe
from .dedup_sql import OP2_SQL, OP3_SQL, OP5_SQL
from .decontamination import OP12_SQL, op12_decontamination
from .minhash import op2_minhash_near_dedup
from .packing import op9_packing
from .page_text import op4_page_text
from .periodic_runs import op11_periodic_runs
from .quality_rules import op8_quality_rules
from .search import OP6_SQL, op6_top_k_search
from .sharding import op10_sharding
from .spelling import op13_spelling_variants
from .substring_dedup import op5_substring_dedup
from .suffix_dedup import op3_suffix_dedup
from .toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_page_text": op4_page_text,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_top_k_search": op6_top_k_search,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_minhash_near_dedup": OP2_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_top_k_search": OP6_SQL,
    "op12_decontamination": OP12_SQL,
}
