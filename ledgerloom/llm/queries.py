"""The corpus operators as registered queries."""

from __future__ import annotations

from . import licenses
from .alignment import op13_token_alignment
from .byte_bpe import op8_byte_bpe
from .embeddings import op2_near_embeddings
from .licenses import op4_licenses
from .mixing import op10_mixing
from .packing import op11_pattern_packing
from .pages import op1_main_text
from .quality import op9_quality
from .sharding import op6_kd_shards
from .simhash import op3_simhash
from .token_files import op7_token_files
from .toxicity import op5_toxicity
from .whitening import op12_whitening

QUERIES = {f.__name__: f for f in (op1_main_text, op2_near_embeddings, op3_simhash, op4_licenses, op5_toxicity, op6_kd_shards, op7_token_files, op8_byte_bpe, op9_quality, op10_mixing, op11_pattern_packing, op12_whitening, op13_token_alignment)}
ORACLE_SQL: dict[str, str] = {"op4_licenses": licenses.ORACLE_SQL}
