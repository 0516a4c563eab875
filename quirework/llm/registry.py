"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .attention_lm import op7_lm_scores
from .audio_features import op9_audio_features
from .bpe import op6_bpe
from .embedding_dedup import OP8_SQL, op8_embedding_dedup
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .lexical_search import OP11_SQL, op11_lexical_search
from .minhash_dedup import OP10_SQL, op10_minhash_dedup
from .mixing import OP3_SQL, op3_mixing
from .quality import op4_quality
from .sharding import op2_sharding
from .substring_dedup import OP1_SQL, op1_substring_dedup
from .token_files import op5_token_files
from .toxicity import op12_toxicity

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_token_files": op5_token_files,
    "op6_bpe": op6_bpe,
    "op7_lm_scores": op7_lm_scores,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_audio_features": op9_audio_features,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op3_mixing": OP3_SQL,
    "op8_embedding_dedup": OP8_SQL,
    "op10_minhash_dedup": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
