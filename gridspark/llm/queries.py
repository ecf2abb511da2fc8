"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .binary_records import op1_binary_records
from .decontamination import op10_decontamination
from .language_id import op8_language_id
from .license_scans import op9_license_scans
from .minhash import op4_minhash
from .multi_index import OP2_SQL, op2_multi_index
from .sentencepiece_bpe import op7_sentencepiece
from .suffix_dedup import op6_suffix_dedup
from .token_counts import op5_token_counts
from .url_filters import OP3_SQL, op3_url_filters

QUERIES = {f.__name__: f for f in (op1_binary_records, op2_multi_index, op3_url_filters, op4_minhash, op5_token_counts, op6_suffix_dedup, op7_sentencepiece, op8_language_id, op9_license_scans, op10_decontamination)}
SQL = {"op2_multi_index": OP2_SQL, "op3_url_filters": OP3_SQL}
