"""Scalar column functions (cleaning, parsing, derived values).

Every function returns a native ``Column`` expression, so a whole transform
stays inside one whole-stage-codegen span: no Python runs per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Text that the landing step treats as a missing value.
NULL_TOKENS = ["nan", "NaN", "NaT", "None", "", "<NA>"]

# Whole-number text, optional sign, optional surrounding whitespace.
INT_TEXT = r"^\s*[+-]?\d+\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- C1 / C2: landing normalisation -----------------------------------------

_LITERALS: dict = {}


def _token_literals(tokens) -> tuple:
    """Literal columns of the tokens and a typed null, built once per
    SparkContext (each literal is a JVM call; flows use them per column)."""
    from pyspark import SparkContext

    key = (id(SparkContext._active_spark_context), tuple(tokens))
    if key not in _LITERALS:
        _LITERALS.clear()
        _LITERALS[key] = ([F.lit(t) for t in tokens], F.lit(None).cast("string"))
    return _LITERALS[key]


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """The landing tokens for "missing" become null; anything else kept."""
    c = _c(c)
    lits, null = _token_literals(tokens)
    return F.when(c.isin(*lits), null).otherwise(c)


def normalize_null_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """C1 over every string column, in one projection."""
    return df.select(*[
        null_tokens(F.col(f"`{f.name}`"), tokens).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def integral_float_text(c) -> Column:
    """C2 (per value): a whole double prints without the fractional part
    (``5.0`` -> ``5``); other values print as they are; null stays null."""
    c = _c(c)
    return (F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
            .when(c == F.floor(c), F.coalesce(c.try_cast("decimal(38,0)").cast("string"), c.cast("string")))
            .otherwise(F.regexp_replace(F.regexp_replace(F.coalesce(c.try_cast("decimal(38,15)").cast("string"), c.cast("string")), "0+$", ""), r"\.$", "")))


# --- C3 .. C17: cleaning ----------------------------------------------------

def trimmed(c) -> Column:
    return F.trim(_c(c))


def zero_pad(c, width: int, null_as_empty: bool = False) -> Column:
    """Left-pad with zeros up to ``width`` without ever truncating."""
    c = _c(c)
    padded = F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)
    return F.coalesce(padded, F.lit("")) if null_as_empty else padded


def municipality_code6(c) -> Column:
    """7-digit municipality codes lose the check digit; blank -> null."""
    t = F.trim(_c(c))
    return F.when(F.length(t) >= 7, F.substring(t, 1, 6)).otherwise(F.nullif(t, F.lit("")))


def strip_leading_zeros(c) -> Column:
    """C11: ``01`` -> ``1``; an all-zero code is kept as it is (``00``)."""
    t = F.trim(_c(c))
    return F.coalesce(F.nullif(F.ltrim(t, F.lit("0")), F.lit("")), t)


def icd_key(c) -> Column:
    """Diagnosis join key, trimmed and without dots."""
    return F.replace(F.trim(_c(c)), F.lit("."), F.lit(""))


def strip_code_prefix(c, pattern: str = r"^\S+\s+") -> Column:
    """Drop the leading code token of a ``code label`` text."""
    return F.regexp_replace(_c(c), pattern, "")


def locale_number(c) -> Column:
    """C14: ``1.234,9`` -> 1234 (thousands dot removed, comma decimal,
    truncated); anything unparsable -> 0."""
    t = F.replace(F.replace(F.trim(_c(c)), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    num = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), t.try_cast("double"))
    return F.coalesce(num, F.lit(0.0)).cast("bigint")


def nullable_int(c) -> Column:
    """``"007"`` -> 7; anything not a whole number -> null."""
    c = _c(c)
    return F.when(c.rlike(INT_TEXT), F.trim(c).try_cast("int"))


def is_blank(c) -> Column:
    """Null or only spaces."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


def effective_key(own, parent):
    """C17: own key when present, else the parent's.  Returns the
    ``(key, used_parent)`` pair; the flag is true only when the parent key
    itself is non-blank."""
    own, parent = _c(own), _c(parent)
    key = F.when(~is_blank(own), own).otherwise(parent)
    used_parent = is_blank(own) & ~is_blank(parent)
    return key, used_parent


# --- C18 .. C22: ages and years ---------------------------------------------

def _unit_and_value(c):
    t = F.trim(_c(c))
    body = F.substring(t, 2, 1 << 20)
    value = F.when(body.rlike(INT_TEXT), body.try_cast("int"))
    return F.substring(t, 1, 1), value


def age_unit_value(c, max_age: int = 120) -> Column:
    """C18 (death records): first digit is the unit.  4 = years, 5 = 100 +
    years, 0-3 (minutes..months) = 0; anything else or outside 0..max -> null."""
    unit, value = _unit_and_value(c)
    raw = (F.when(unit == "4", value)
           .when(unit == "5", value + 100)
           .when(unit.isin("0", "1", "2", "3"), F.lit(0)))
    return F.when(raw.between(0, max_age), raw)


def age_unit_value_strict(c) -> Column:
    """C19 (work registry): 4 = years, 5 = 100 + years, other units null; no cap."""
    unit, value = _unit_and_value(c)
    return F.when(unit == "4", value).when(unit == "5", value + 100)


def age_sentinel(c, sentinel: str = "999") -> Column:
    """C20: the sentinel means unknown; other whole numbers parse."""
    t = F.trim(_c(c))
    return F.when(t == sentinel, F.lit(None).cast("int")).otherwise(nullable_int(t))


def year_ddmmyyyy(c) -> Column:
    """Year of a ``DDMMAAAA`` text, only when it has 8 characters."""
    t = F.trim(_c(c))
    y = F.substring(t, 5, 4)
    return F.when((F.length(t) == 8) & y.rlike(r"^\d{4}$"), y.cast("int"))


def year_yymmdd(c, century: int = 1900) -> Column:
    """Year of an ``AAMMDD`` text (partial allowed): first two digits."""
    t = F.trim(_c(c))
    return F.when(t.rlike(r"^\d{2}"), F.substring(t, 1, 2).cast("int") + century)


def signed_days(c, sentinel: str = "99999") -> Column:
    """Days between two events written with a sign (``+12`` after, ``-3``
    before); the sentinel means no information -> null."""
    t = F.trim(_c(c))
    digits = F.regexp_extract(t, r"^[+-]?(\d+)$", 1)
    return F.when((digits == "") | (digits == sentinel), F.lit(None).cast("int")).otherwise(
        F.when(t.startswith("-"), -digits.try_cast("int")).otherwise(digits.try_cast("int")))


# --- C23 / C24 ----------------------------------------------------------------

def constant(value, dtype: str = "string") -> Column:
    """A constant tag column."""
    return F.lit(value).cast(dtype)


def code_label_concat(code, label, sep: str = " - ") -> Column:
    """``code - label``; the code alone when there is no label."""
    code, label = _c(code), _c(label)
    return F.when(label.isNotNull(), F.concat(code, F.lit(sep), label)).otherwise(code)


# --- header-level helpers (names only, driver side) ---------------------------

def normalize_header(name: str) -> str:
    """Strip BOM and spaces, remove accents (NFKD), upper-case."""
    n = name.replace("﻿", "").strip()
    n = unicodedata.normalize("NFKD", n)
    n = "".join(ch for ch in n if not unicodedata.combining(ch))
    return n.upper()
