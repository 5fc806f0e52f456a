"""Queries and SQL of this package, by name."""

from importlib import import_module

_MODULES = ("ngram_join", "suffix_dedup", "line_dedup", "decontaminate", "packing", "token_shards", "langid", "toxicity", "ann_dedup", "pii")

QUERIES: dict = {}
SQL: dict = {}
for _name in _MODULES:
    _module = import_module(f"millrace.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    SQL.update(getattr(_module, "SQL", {}))
