"""Lookup joins (J1-J10): left equi-joins of a large fact table to small
dimensions.

Whether a dimension is broadcast is Spark's decision, from size statistics in
bytes and, at run time, from adaptive execution; building a plan starts no job.
Dimensions are made key-unique first, so a left lookup never multiplies fact
rows (the J10 guard).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import _c, code_label_concat


def left_join(fact: DataFrame, fact_key: Column, dim: DataFrame, dim_key: str) -> DataFrame:
    """Left equi-join of ``fact`` to a key-unique ``dim``.  The plan carries no
    hint: Spark broadcasts a side whose size statistics stay under
    ``spark.sql.autoBroadcastJoinThreshold`` (bytes, not rows), and adaptive
    execution splits a key that holds much of the fact otherwise."""
    return fact.join(dim, fact_key == F.col(dim_key), "left")


def unique_by_key(dim: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest row by ``order`` (default: the other
    columns).  A ``min`` over a struct is partially aggregated map-side, so
    a hot key never lands whole in one task."""
    rest = [c for c in dim.columns if c != key]
    order = order or rest
    payload = [c for c in rest if c not in order]
    s = F.min(F.struct(*[F.col(c) for c in order + payload])).alias("_s")
    return dim.groupBy(key).agg(s).select(key, *[F.col(f"_s.{c}").alias(c) for c in rest])


def lookup_label(fact: DataFrame, key: Column, dim: DataFrame, dim_key: str, label: str,
                 out: str) -> DataFrame:
    """Add ``out`` = dim[label] where ``key`` = dim[dim_key] (left)."""
    d = unique_by_key(dim.select(dim_key, label), dim_key).select(
        F.col(dim_key).alias("_lk_key"), F.col(label).alias(out))
    f = fact.withColumn("_lk_fact_key", key)
    return left_join(f, F.col("_lk_fact_key"), d, "_lk_key").drop("_lk_fact_key", "_lk_key")


def lookup_concat(fact: DataFrame, col: str, dim: DataFrame, dim_key: str, label: str,
                  out: str | None = None, sep: str = " - ") -> DataFrame:
    """``code - label`` in place of the code (or as ``out``); code alone
    when unmatched."""
    tmp = "_lk_label"
    joined = lookup_label(fact, F.col(col), dim, dim_key, label, tmp)
    target = out or col
    return joined.withColumn(target, code_label_concat(F.col(col), F.col(tmp), sep)).drop(tmp)


def lookup_conditional(fact: DataFrame, col: str, states: DataFrame, countries: DataFrame,
                       key: str = "codigo", label: str = "descricao", out: str | None = None,
                       marker: str = "8") -> DataFrame:
    """A code starting with ``marker`` names a state by its characters 2-3,
    any other code names a country by the whole code.  Result: the label or null."""
    c = F.col(col)
    is_state = F.substring(c, 1, 1) == marker
    j = lookup_label(fact, F.when(is_state, F.substring(c, 2, 2)), states, key, label, "_lk_state")
    j = lookup_label(j, F.when(~is_state, c), countries, key, label, "_lk_country")
    return (j.withColumn(out or col, F.when(is_state, F.col("_lk_state")).otherwise(F.col("_lk_country")))
            .drop("_lk_state", "_lk_country"))


def synonym_resolve(fact: DataFrame, col: str, synonyms: DataFrame, old: str, new: str,
                    out: str) -> DataFrame:
    """Current code = synonym map[code] when mapped, else the code; the
    original column is kept."""
    j = lookup_label(fact, F.col(col), synonyms, old, new, "_lk_new")
    return j.withColumn(out, F.coalesce(F.col("_lk_new"), F.col(col))).drop("_lk_new")


def enrich_found_flag(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                      flag: str, order: list[str] | None = None,
                      columns: list[str] | None = None) -> DataFrame:
    """Right side deduped by key (smallest by ``order`` wins), left join,
    boolean "found" flag; left rows are never dropped or multiplied.
    ``columns`` are the right side's columns to bring over (default: all)."""
    if columns is not None:
        right = right.select(*[F.col(f"`{c}`") for c in dict.fromkeys([right_key, *columns])])
    r = unique_by_key(right, right_key, order).withColumn("_lk_found", F.lit(True))
    r = r.withColumnRenamed(right_key, "_lk_rkey")
    j = left_join(left, F.col(f"`{left_key}`"), r, "_lk_rkey")
    return j.withColumn(flag, F.coalesce(F.col("_lk_found"), F.lit(False))).drop("_lk_found", "_lk_rkey")


def three_way_reference(base: DataFrame, refs) -> DataFrame:
    """Keep every base column and add each reference's columns, excluding
    its key.  ``refs`` = [(table, base_key, table_key), ...]; every reference
    is made key-unique first, so the base row count never changes."""
    out = base
    for table, base_key, table_key in refs:
        d = unique_by_key(table, table_key).withColumnRenamed(table_key, "_ref_key")
        out = left_join(out, F.col(f"`{base_key}`"), d, "_ref_key").drop("_ref_key")
    return out


def duplicate_keys(dim: DataFrame, key) -> DataFrame:
    """The keys of ``dim`` that occur more than once (empty = a left join
    on this key cannot multiply rows).  One aggregation, no second count."""
    k = _c(key)
    return dim.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(dim: DataFrame, key) -> None:
    dup = duplicate_keys(dim, key).limit(1).collect()
    if dup:
        raise ValueError(f"lookup key is not unique: {dup[0]['key']!r} occurs {dup[0]['n']} times")
