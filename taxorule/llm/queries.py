"""Queries of the training-data operators and their SQL, for the driver's entry file."""

from __future__ import annotations

from .chat import CHAT_SQL, q_chat
from .columnbwt import q_suffix_dedup
from .debruijn import q_substring_dedup
from .filteraudit import AUDIT_SQL, q_filter_audit
from .licenses import q_licenses
from .lzprint import q_lzprint
from .mixing import MIXING_SQL, q_mixing
from .ordinal import q_ordinal
from .packing import q_packing
from .ppm import q_ppm
from .rulelist import q_rulelist
from .simhash import q_simhash
from .whitening import q_whitening

QUERIES = {
    "op1_simhash_near_dedup": q_simhash,
    "op2_quality_classifier": q_ordinal,
    "op3_quality_rules": q_rulelist,
    "op4_lz_fingerprint": q_lzprint,
    "op5_license_scan": q_licenses,
    "op6_suffix_dedup": q_suffix_dedup,
    "op7_chat_format": q_chat,
    "op8_source_mixing": q_mixing,
    "op9_best_fit_packing": q_packing,
    "op10_ppm_score": q_ppm,
    "op11_embedding_whitening": q_whitening,
    "op12_substring_dedup": q_substring_dedup,
    "op13_filter_audit": q_filter_audit,
}

ORACLE_SQL = {
    "op7_chat_format": CHAT_SQL,
    "op8_source_mixing": MIXING_SQL,
    "op13_filter_audit": AUDIT_SQL,
}
