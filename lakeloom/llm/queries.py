"""The subpackage's queries, by name, and the DuckDB SQL of those that SQL can express.

Beside the operators' queries, those in EXTRA give the columns that SQL can tell of an operator whose whole result it can't.
"""

from __future__ import annotations

from importlib import import_module

_MODULES = ("line_dedup", "media", "mixing", "chat", "licenses", "minhash", "toxicity", "decontam", "chaining", "lm")

EXTRA = ("media_digests", "lm_counts")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in _MODULES:
    _module = import_module(f"{__package__}.{_name}")
    QUERIES |= {k: v for k, v in vars(_module).items() if k in EXTRA or (k.startswith("op") and k[2:3].isdigit())}
    SQL |= _module.SQL
