"""Operators that prepare a training corpus; nothing else in the library imports this subpackage."""

from __future__ import annotations

from folioloom.llm import chat_format, decontamination, exact_dedup, language_id, license_scan, mixing, near_dedup, quality_cnn, token_counts, token_files

_MODULES = (exact_dedup, decontamination, chat_format, language_id, license_scan, mixing, near_dedup, quality_cnn, token_counts, token_files)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
