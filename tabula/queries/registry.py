"""Registry of named queries: the Spark callable and its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, views=()):
    """Register ``fn(t: Tables) -> DataFrame`` as ``name``.

    ``oracle`` is the DuckDB SQL body; ``views`` are the binding views it
    reads (added as a WITH prefix)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(views, oracle)
        return fn

    return deco
