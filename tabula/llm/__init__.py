"""Training-data operators: one module each, with its query and oracle.

Nothing else in the library imports this package."""

from importlib import import_module

_MODULES = ["quality", "chat", "shards", "tokencount", "packing", "neardup", "decontaminate", "pii", "licences", "lm", "jaccard", "phrases", "whitening"]

QUERIES: dict = {}
ORACLES: dict = {}
for _m in _MODULES:
    _mod = import_module(f"{__name__}.{_m}")
    QUERIES.update(_mod.QUERIES)
    ORACLES.update(_mod.ORACLES)

__all__ = ["QUERIES", "ORACLES"]
