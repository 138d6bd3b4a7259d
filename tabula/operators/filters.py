"""Row predicates (F1-F11).  Each returns a boolean ``Column``; ``keep``
applies one to a DataFrame so the predicate can be pushed into the scan."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import _c, is_blank


def keep(df: DataFrame, predicate: Column) -> DataFrame:
    """Filter; a null predicate drops the row, as in SQL."""
    return df.filter(F.coalesce(predicate, F.lit(False)))


def _two_digits_after(c: Column, letters: str):
    m = r"^([" + letters + r"])(\d{2})"
    return F.regexp_extract(c, m, 1), F.regexp_extract(c, m, 2)


def icd10_onco(c, malignant_only: bool = False) -> Column:
    """F1 (as coded): trimmed, upper-cased code ``^[CDB]\\d\\d``; C00-C97,
    D00-D48 and B21.  F2 (``malignant_only``): C00-C97 only."""
    t = F.upper(F.trim(_c(c)))
    letter, num = _two_digits_after(t, "CDB")
    n = F.when(num != "", num.cast("int"))
    pred = (letter == "C") & (n <= 97)
    if not malignant_only:
        pred = pred | ((letter == "D") & (n <= 48)) | ((letter == "B") & (n == 21))
    return F.coalesce(pred, F.lit(False))


def icd9_malignant(c, low: int = 140, high: int = 208) -> Column:
    """the three leading digits of the trimmed code lie in 140..208."""
    d = F.regexp_extract(F.trim(_c(c)), r"^(\d{3})", 1)
    return F.coalesce((d != "") & F.when(d != "", d.cast("int")).between(low, high), F.lit(False))


def drug_onco(c) -> Column:
    """any C code; D00-D09 and D37-D48; prefixes B21, Z51, Z08, Z85."""
    t = F.upper(F.trim(_c(c)))
    d = F.regexp_extract(t, r"^D(\d{2})", 1)
    dn = F.when(d != "", d.cast("int"))
    pred = (t.startswith("C") | dn.between(0, 9) | dn.between(37, 48)
            | t.startswith("B21") | t.startswith("Z51") | t.startswith("Z08") | t.startswith("Z85"))
    return F.coalesce(pred, F.lit(False))


def code_set_tolerant(c, codes) -> Column:
    """membership that tolerates dots and leading zeros: the trimmed
    code, the code without dots, or the code without dots and leading zeros
    padded back to four digits."""
    codes = list(codes)
    t = F.trim(_c(c))
    nodot = F.replace(t, F.lit("."), F.lit(""))
    stripped = F.ltrim(nodot, F.lit("0"))
    norm = F.when(F.length(stripped) < 4, F.lpad(stripped, 4, "0")).otherwise(stripped)
    return F.coalesce(t.isin(codes) | nodot.isin(codes) | norm.isin(codes), F.lit(False))


def normalized_code(c, width: int = 4) -> Column:
    """The F5 normal form of a code (no dots, no leading zeros, padded)."""
    nodot = F.replace(F.trim(_c(c)), F.lit("."), F.lit(""))
    stripped = F.ltrim(nodot, F.lit("0"))
    return F.when(F.length(stripped) < width, F.lpad(stripped, width, "0")).otherwise(stripped)


def keyword_pattern(keywords) -> str:
    return "|".join(re.escape(k) for k in keywords)


def keyword_match(c, keywords) -> Column:
    """case-insensitive "contains any keyword" over the whole text.  The
    keywords are literal text, so after ``lower`` this is a chain of native
    substring tests (no regex engine per row)."""
    low = F.lower(_c(c))
    pred = None
    for k in dict.fromkeys(k.lower() for k in keywords):
        p = low.contains(k)
        pred = p if pred is None else pred | p
    return F.coalesce(pred if pred is not None else F.lit(False), F.lit(False))


# Keywords that mark a federal grant as cancer related.
GRANT_KEYWORDS = [
    "cancer", "câncer", "oncologic", "oncológic", "oncologia",
    "quimioterapia", "radioterapia", "mastologia", "mastectomia",
    "hemato-oncologico", "hemato-oncológico", "tumor maligno",
    "carcinoma", "neoplasia", "inca ",
]


def fixed_width_equals(line, pos: int, length: int, value: str) -> Column:
    """a raw-line position equals a value (checked before any parsing)."""
    return F.substring(_c(line), pos, length) == F.lit(value)


def active_reference(status, code) -> Column:
    """active status and a real municipality code (not 000000, not *9999)."""
    s = F.upper(F.trim(_c(status)))
    t = _c(code)
    padded = F.when(F.length(t) < 6, F.lpad(t, 6, "0")).otherwise(t)
    return F.coalesce((s == "ATIVO") & (padded != "000000") & ~padded.endswith("9999"), F.lit(False))


def is_real_municipality(code) -> Column:
    t = _c(code)
    return (t != "000000") & ~t.endswith("9999")


def not_control_file(name, pattern: str = r"(^|/)(_|\.)|manifest|metadados") -> Column:
    """exclude control files (manifests, hidden and underscore files)."""
    return ~F.lower(_c(name)).rlike(pattern)


def not_blank(c) -> Column:
    return ~is_blank(c)
