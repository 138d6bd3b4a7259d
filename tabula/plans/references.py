"""Code reference tables (cause of death by era, occupation, country, state)
built from the raw code tables: label prefix stripped (C13), padded codes
(C9), one row per code (A7), two occupation vocabularies merged with the
newer one winning (A8).  ``order`` is the delivered row order (first wins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import strip_code_prefix, zero_pad
from ..operators.rollups import dedupe_first, priority_dedupe


def _strip(c):
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def causes(raw: DataFrame, code: str, label: str, order: str, prefix: str = r"^\S+\s+") -> DataFrame:
    d = raw.select(F.col(code).alias("CODIGO"), _strip(strip_code_prefix(F.col(label), prefix)).alias("DESCRICAO"),
                   F.col(order).alias("_o"))
    return dedupe_first(d, ["CODIGO"], ["_o"]).drop("_o")


def occupations(new: DataFrame | None, old: DataFrame, order: str = "ordem") -> DataFrame:
    """CBO-2002 wins over the old 3-digit codes, which are offered as NNN and NNN00."""
    o = old.select(zero_pad(F.col("CODIGO"), 3).alias("CODIGO"), _strip(F.col("DESCRICAO")).alias("DESCRICAO"),
                   F.col(order).alias("_o"))
    old_forms = o.unionByName(o.withColumn("CODIGO", F.concat("CODIGO", F.lit("00"))))
    frames = [old_forms]
    if new is not None:
        n = new.select(_strip(F.col("CODIGO")).alias("CODIGO"), _strip(F.col("DESCRICAO")).alias("DESCRICAO"),
                       F.col(order).alias("_o")).filter((F.col("CODIGO") != "") & (F.col("DESCRICAO") != ""))
        frames = [n, old_forms]
    return priority_dedupe(frames, "CODIGO", ["_o"]).drop("_o")


def countries(raw: DataFrame, order: str = "ordem") -> DataFrame:
    d = dedupe_first(raw.select("CODIGO", "DESCRICAO", F.col(order).alias("_o")), ["CODIGO"], ["_o"])
    return d.select(zero_pad(F.col("CODIGO"), 3).alias("CODIGO"), _strip(F.col("DESCRICAO")).alias("DESCRICAO"))


def states(raw: DataFrame, order: str = "ordem") -> DataFrame:
    d = dedupe_first(raw.select("CODIGO", "DESCRICAO", "SIGLA_UF", F.col(order).alias("_o")), ["CODIGO"], ["_o"])
    return d.select("CODIGO", _strip(F.col("DESCRICAO")).alias("DESCRICAO"), "SIGLA_UF")
