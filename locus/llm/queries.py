"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from .bpe import op10_bpe
from .embedding_dedup import OP5_SQL, op5_embedding_dedup
from .fingerprint import op3_fingerprints
from .language_id import op1_language_id
from .lm_scoring import op4_lm_scoring
from .mixing import OP2_SQL, op2_mixing
from .sharding import OP8_SQL, op8_sharding
from .simhash import op7_simhash
from .suffix_dedup import op6_suffix_dedup
from .toxicity import op9_toxicity

QUERIES = {
    f.__name__: f
    for f in (op1_language_id, op2_mixing, op3_fingerprints, op4_lm_scoring, op5_embedding_dedup, op6_suffix_dedup, op7_simhash, op8_sharding, op9_toxicity, op10_bpe)
}

ORACLES = {op2_mixing.__name__: OP2_SQL, op5_embedding_dedup.__name__: OP5_SQL, op8_sharding.__name__: OP8_SQL}
