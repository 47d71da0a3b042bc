"""All queries by name."""

from __future__ import annotations

from tideline.plans import bodies, feeds, landing, metrics, profiles, streams, trade

_MODULES = [metrics, trade, feeds, landing, profiles, bodies, streams]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: text for m in _MODULES for name, text in m.ORACLE.items()}
