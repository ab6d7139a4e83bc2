"""Contract queries of the llm operators, and SQL twins where SQL can say them."""

from __future__ import annotations

from .compress_quality import op6
from .debruijn import op12
from .decontam import op9
from .license_scan import op5
from .ngram_join import op2
from .packing import op8
from .prefix_trie import op11
from .resample import op13
from .risk_rules import ORACLE as RULES_SQL
from .risk_rules import op7
from .secret_scan import op4
from .suffix_dedup import op3
from .token_counts import op1
from .token_store import op10

QUERIES = {
    "op1_trie_token_counts": op1,
    "op2_ngram_jaccard_join": op2,
    "op3_suffix_array_dedup": op3,
    "op4_secret_scan": op4,
    "op5_license_scan": op5,
    "op6_compression_quality": op6,
    "op7_risk_controlled_rules": op7,
    "op8_best_fit_packing": op8,
    "op9_benchmark_decontamination": op9,
    "op10_token_store": op10,
    "op11_conversation_prefix_trie": op11,
    "op12_debruijn_substring_dedup": op12,
    "op13_importance_resampling": op13,
}
ORACLE: dict[str, str] = {"op7_risk_controlled_rules": RULES_SQL}
