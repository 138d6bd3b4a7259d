"""Edge rows for the scalar column functions (FIXTURES §3)."""

from pyspark.sql import functions as F

from tabula.functions import columns as C

from .conftest import one_col


def apply(spark, fn, values, dtype="string"):
    df = one_col(spark, values, dtype=dtype)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_null_tokens(spark):
    vals = ["nan", "NaN", "NaT", "None", "", "<NA>", "NULL", "nat", "x"]
    assert apply(spark, C.null_tokens, vals) == [None] * 6 + ["NULL", "nat", "x"]


def test_normalize_null_tokens_only_strings(spark):
    df = spark.createDataFrame([("None", 1)], "a string, b int")
    assert C.normalize_null_tokens(df).collect()[0] == (None, 1)


def test_integral_float_text(spark):
    assert apply(spark, C.integral_float_text, [5.0, 0.25, None, -3.0], "double") == ["5", "0.25", None, "-3"]


def test_zero_pad(spark):
    assert apply(spark, lambda c: C.zero_pad(c, 7, True), ["12", "123456789", None]) == ["0000012", "123456789", ""]


def test_municipality_code6(spark):
    assert apply(spark, C.municipality_code6, ["3550308", "355030", " ", None]) == ["355030", "355030", None, None]


def test_strip_leading_zeros(spark):
    assert apply(spark, C.strip_leading_zeros, ["01", "00", " 03", None]) == ["1", "00", "3", None]


def test_icd_key(spark):
    assert apply(spark, C.icd_key, [" C50.9 ", "C509"]) == ["C509", "C509"]


def test_locale_number(spark):
    assert apply(spark, C.locale_number, ["1.234", "1.234,9", "-", "12", "", None]) == [1234, 1234, 0, 12, 0, 0]


def test_nullable_int(spark):
    assert apply(spark, C.nullable_int, ["007", "12.5", "1e2", "", "x", " 4 "]) == [7, None, None, None, None, 4]


def test_age_unit_value(spark):
    vals = ["410", "505", "305", "590", "999", "4xx", "", None, "0", "4120", "4121"]
    assert apply(spark, C.age_unit_value, vals) == [10, 105, 0, None, None, None, None, None, 0, 120, None]


def test_age_unit_value_strict(spark):
    assert apply(spark, C.age_unit_value_strict, ["4035", "5003", "3011", "5090"]) == [35, 103, None, 190]


def test_age_sentinel(spark):
    assert apply(spark, C.age_sentinel, ["999", "057", " 999 ", "x"]) == [None, 57, None, None]


def test_years(spark):
    assert apply(spark, C.year_ddmmyyyy, ["31122005", "3112", "311220ab"]) == [2005, None, None]
    assert apply(spark, C.year_yymmdd, ["95", "950500", "9A", None]) == [1995, 1995, None, None]


def test_is_blank_and_effective_key(spark):
    df = spark.createDataFrame([("J1", "M1"), (" ", "M2"), (None, None), ("", " ")], "own string, parent string")
    key, via = C.effective_key("own", "parent")
    got = [tuple(r) for r in df.select(key, via).collect()]
    assert got == [("J1", False), ("M2", True), (None, False), (" ", False)]


def test_code_label_concat(spark):
    df = spark.createDataFrame([("001", "X"), ("002", None)], "c string, l string")
    assert [r[0] for r in df.select(C.code_label_concat("c", "l")).collect()] == ["001 - X", "002"]


def test_normalize_header():
    assert C.normalize_header("﻿ Código Convênio ") == "CODIGO CONVENIO"
