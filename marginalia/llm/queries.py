"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .chat import OP8_SQL, op8_chat
from .counts import op6_token_counts
from .jaccard import OP3_SQL, op3_jaccard
from .language import op4_language_id
from .media import op10_media
from .mixing import op7_mixing
from .packing import op1_packing
from .repeats import OP5_SQL, op5_repeats
from .search import OP2_SQL, op2_knn
from .secrets import op9_secrets

QUERIES = {
    "op1_packing": op1_packing,
    "op2_knn": op2_knn,
    "op3_jaccard": op3_jaccard,
    "op4_language_id": op4_language_id,
    "op5_repeats": op5_repeats,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_chat": op8_chat,
    "op9_secrets": op9_secrets,
    "op10_media": op10_media,
}
ORACLE_SQL: dict[str, str] = {"op2_knn": OP2_SQL, "op3_jaccard": OP3_SQL, "op5_repeats": OP5_SQL, "op8_chat": OP8_SQL}
