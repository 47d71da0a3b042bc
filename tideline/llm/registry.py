"""Queries of the training-data operators by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tideline.llm import (
    byte_bpe, decontaminate, filter_audit, hard_negatives, line_dedup, quality, rules, sanitise, secrets, sharding, simhash,
    token_counts, toxicity,
)

_MODULES = [
    decontaminate, toxicity, quality, rules, line_dedup, token_counts, secrets, simhash, sharding, byte_bpe, filter_audit,
    hard_negatives, sanitise,
]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: text for m in _MODULES for name, text in m.ORACLE.items()}
