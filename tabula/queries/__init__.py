"""Named queries over the driver tables (one per operator / curation flow).

Importing this package registers every query in ``registry.QUERIES`` and its
DuckDB oracle (when SQL can express it) in ``registry.ORACLES``."""

from importlib import import_module

from .registry import ORACLES, QUERIES

_MODULES = ["aggregating", "cleaning", "decoding", "filtering", "joining", "reshaping", "merging", "planning", "sources", "catalogue", "curation", "streaming", "documented", "incremental", "delivery", "contracts"]

for _m in _MODULES:
    import_module(f"{__name__}.{_m}")

__all__ = ["QUERIES", "ORACLES"]
