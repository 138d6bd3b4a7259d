"""Reshape (R1-R3): matrix to long form, list/range explode, synonym map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import locale_number
from .filters import active_reference, is_real_municipality

LONG_COLUMNS = ["VISAO", "EXAME", "PERFIL", "DIMENSAO_LINHA", "CATEGORIA_LINHA",
                "DIMENSAO_COLUNA", "CATEGORIA_COLUNA", "MEDIDA", "QTD"]


def unpivot_matrix(matrix: DataFrame, tags: dict | None = None, ids=()) -> DataFrame:
    """First column (after ``ids``) = row category; ``total`` rows and
    columns dropped; melt; locale number (C14); keep positive quantities; add
    tag columns.  ``ids`` are extra key columns carried through (several
    matrices stacked in one table, e.g. per view and year)."""
    tags = tags or {}
    ids = list(ids)
    rest = [c for c in matrix.columns if c not in ids]
    id_col = rest[0]
    values = [c for c in rest[1:] if c.strip().lower() != "total"]
    rows = matrix.filter(~F.coalesce(F.lower(F.trim(F.col(f"`{id_col}`"))).isin("total", ""), F.lit(False)))
    rows = rows.select(*[F.col(f"`{i}`") for i in ids], F.col(f"`{id_col}`").alias("CATEGORIA_LINHA"),
                       *[F.col(f"`{v}`").cast("string").alias(v) for v in values])
    long = rows.unpivot(ids + ["CATEGORIA_LINHA"], values, "CATEGORIA_COLUNA", "_raw")
    long = long.select(*ids, F.trim("CATEGORIA_LINHA").alias("CATEGORIA_LINHA"), "CATEGORIA_COLUNA",
                       locale_number("_raw").alias("QTD")).filter(F.col("QTD") > 0)
    out = []
    for c in LONG_COLUMNS:
        if c in ("CATEGORIA_LINHA", "CATEGORIA_COLUNA", "QTD"):
            out.append(F.col(c))
        elif c in ids:
            out.append(F.col(c))
        else:
            out.append(F.lit(tags.get(c)).cast("string").alias(c))
    return long.select(*out, *[F.col(i) for i in ids if i not in LONG_COLUMNS])


# Fixed value: a synonym range wider than this is an administrative range, not a list.
MAX_RANGE = 200
_RANGE = r"^(\d{1,18})\s*-\s*(\d{1,18})$"


def _parts(df: DataFrame, col: str) -> DataFrame:
    """One row per comma-separated part, its position, and the bounds of a range."""
    cut = df.select("*", F.posexplode(F.split(F.coalesce(F.col(col), F.lit("")), ",")).alias("_pos", "_raw"))
    part = F.trim("_raw")
    return cut.select("*", part.alias("_part"), F.regexp_extract(part, _RANGE, 1).alias("_a"),
                      F.regexp_extract(part, _RANGE, 2).alias("_b")).drop("_raw")


def _range_state(max_range: int):
    """None for a part that is no range, else ``ok`` or why it is left out."""
    lo, hi = F.col("_a").try_cast("bigint"), F.col("_b").try_cast("bigint")
    return (F.when(F.col("_a") == "", F.lit(None).cast("string"))
            .when(F.length("_a") != F.length("_b"), "widths differ").when(hi < lo, "descending")
            .when(hi - lo + 1 > max_range, "too wide").otherwise("ok"))


def range_list_explode(df: DataFrame, col: str, out: str = "codigo", width: int = 6,
                       max_range: int = MAX_RANGE) -> DataFrame:
    """R2: comma-separated codes and ``a-b`` ranges (equal width, at most
    ``max_range`` codes) -> one row per code, cut to ``width``.  A single code
    is zero-padded to ``width``, a range's codes keep the width of its bounds.
    Junk parts are ignored; ``rejected_ranges`` lists the ranges left out.
    Keeps the other columns and the part position."""
    parts = _parts(df, col)
    whole = F.sequence(F.col("_a").try_cast("bigint"), F.col("_b").try_cast("bigint"))
    seq = (F.when(_range_state(max_range) == "ok", whole)
           .when(F.col("_part").rlike(r"^\d+$"), F.array(F.lit(-1).cast("bigint")))
           .otherwise(F.array().cast("array<bigint>")))
    exploded = parts.select("*", F.posexplode(seq).alias("_sub", "_n"))
    single = F.when(F.length("_part") < width, F.lpad("_part", width, "0")).otherwise(F.col("_part"))
    text = F.when(F.col("_n") >= 0, F.lpad(F.col("_n").cast("string"), F.length("_a"), "0")).otherwise(single)
    return (exploded.withColumn(out, F.substring(text, 1, width))
            .drop("_part", "_n", "_a", "_b").withColumnRenamed("_sub", "_subpos"))


def rejected_ranges(df: DataFrame, col: str, max_range: int = MAX_RANGE) -> DataFrame:
    """R2's reject table: the ranges that ``range_list_explode`` leaves out,
    with the other columns, the part and the reason."""
    return (_parts(df, col).withColumn("motivo", _range_state(max_range)).filter(F.col("motivo") != "ok")
            .withColumnRenamed("_part", "parte").drop("_a", "_b", "_pos"))


def synonym_map(cadmun: DataFrame, code: str, status: str, synonyms: str, order: str,
                old_name: str = "COD_MUNICIPIO_ANTIGO", new_name: str = "COD_MUNICIPIO_ATUAL") -> DataFrame:
    """Old -> current code from active, real rows; old != current and
    real; when an old code is listed twice the last writer (``order``, then
    position in the list) wins.  ``max_by`` aggregates partially (skew-safe)."""
    act = cadmun.filter(active_reference(F.col(status), F.col(code)))
    cur = F.when(F.length(code) < 6, F.lpad(code, 6, "0")).otherwise(F.col(code))
    act = act.select(cur.alias("_cur"), F.col(order).alias("_ord"), F.col(synonyms))
    ex = range_list_explode(act, synonyms, "_old")
    ex = ex.filter((F.col("_old") != F.col("_cur")) & is_real_municipality(F.col("_old")))
    return (ex.groupBy(F.col("_old").alias(old_name))
            .agg(F.max_by("_cur", F.struct("_ord", "_pos", "_subpos")).alias(new_name)))
