"""Aggregations.

Every rollup is a ``groupBy().agg()`` of partially-aggregatable functions
(``count``, ``sum``, ``min``/``max``, ``bool_or``, ``min_by``/``max_by``,
``collect_set``), so the map side combines rows before the shuffle and a key
holding a third of the data never sends that third across the network.
"First by order" is always an explicit ``min_by`` / ``min(struct)`` with a
total order, never ``first()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import _c, is_blank


def sorted_distinct_list(c, sep: str = "; ", skip_blank: bool = False) -> Column:
    """Sorted distinct values joined with ``sep`` (nulls skipped)."""
    c = _c(c)
    if skip_blank:
        c = F.when(~is_blank(c), c)
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def sum_all_null(c) -> Column:
    """A2: sum of valid numbers; null when no value is valid (``min_count=1``)."""
    return F.sum(_c(c))


def first_non_null(c, order) -> Column:
    """A3 helper: the value of ``c`` on the smallest ``order`` among rows where
    ``c`` is not null."""
    c = _c(c)
    return F.min_by(c, F.when(c.isNotNull(), _c(order)))


def kept_vs_total(df: DataFrame, by, predicate: Column, total: str = "total",
                  kept: str = "kept") -> DataFrame:
    """A5: in one pass, rows per key and rows meeting the predicate."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(total),
                              F.count_if(F.coalesce(predicate, F.lit(False))).alias(kept))


def ratio(kept, total, digits: int = 4) -> Column:
    """Kept / total rounded; null when total is 0 or null, or kept null."""
    k, t = _c(kept), _c(total)
    return F.when((t != 0) & k.isNotNull(), F.round(k.cast("double") / t.cast("double"), digits))


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` (a total order).
    ``min(struct(order..., rest...))`` aggregates partially: skew-safe."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    s = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_s")
    return (df.groupBy(*keys).agg(s)
            .select(*keys, *[F.col(f"_s.`{c}`").alias(c) for c in df.columns if c not in keys])
            .select(*df.columns))


def priority_dedupe(frames: list[DataFrame], key: str, order: list[str] | None = None) -> DataFrame:
    """Union of vocabularies; the earlier frame in the list wins a key,
    then the smallest ``order`` within a frame."""
    tagged = [f.withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in (key, "_prio")]
    return dedupe_first(u, [key], ["_prio"] + list(order or [])).select(key, *cols)


def count_by(df: DataFrame, by, name: str = "n") -> DataFrame:
    """A4: rows per key."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))
