"""Queries and oracle SQL of the training-data operators."""

from tidemark.llm import exact_dedup, mixing, near_dedup, sharding
from tidemark.llm.exact_dedup import op5_exact_dedup
from tidemark.llm.flac import op7_media
from tidemark.llm.html_text import op6_html_text
from tidemark.llm.language_model import op3_lm_scoring
from tidemark.llm.mixing import op8_mixing
from tidemark.llm.near_dedup import op1_near_dedup
from tidemark.llm.packing import op2_packing
from tidemark.llm.sharding import op10_sharding
from tidemark.llm.token_counts import op9_token_counts
from tidemark.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_packing": op2_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_text": op6_html_text,
    "op7_media": op7_media,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": near_dedup.ORACLE_SQL,
    "op5_exact_dedup": exact_dedup.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op10_sharding": sharding.ORACLE_SQL,
}
