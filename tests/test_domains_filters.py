"""Edge rows for decoding and filters (FIXTURES §3)."""

from pyspark.sql import functions as F

from tabula.functions import domains as D
from tabula.operators import filters as fl

from .conftest import one_col

SEX = {"1": "Masculino", "2": "Feminino"}


def col(spark, fn, values):
    return [r[0] for r in one_col(spark, values).select(fn(F.col("v"))).collect()]


def test_decoders(spark):
    vals = ["7", None, " 1 "]
    assert col(spark, lambda c: D.decode_else_default(c, SEX), vals) == ["Ignorado", "Ignorado", "Masculino"]
    assert col(spark, lambda c: D.decode_keep_unknown(c, SEX), vals) == ["7", None, "Masculino"]
    assert col(spark, lambda c: D.decode_blank_empty(c, SEX), vals) == ["7", "", "Masculino"]


def test_decode_strip_zeros_and_padded(spark):
    assert col(spark, lambda c: D.decode_keep_unknown(c, {"1": "I"}, strip_zeros=True), ["01", "00"]) == ["I", "00"]
    assert col(spark, lambda c: D.decode_padded(c, {"05": "Hospital Geral"}, 2), ["5", "99", None]) == \
        ["Hospital Geral", "99", None]


def test_flag_yes_no(spark):
    assert col(spark, D.flag_yes_no, ["1.0", " sim ", "NÃO", "x", None, "f"]) == ["Sim", "Sim", "Não", None, None, "Não"]


def keep(spark, pred, values):
    df = one_col(spark, values)
    return [r[0] for r in fl.keep(df, pred(F.col("v"))).collect()]


def test_f1_as_coded(spark):
    vals = ["C00", "c97 ", "D10", "D48", "B21", "C98", "D49", "B20", "C9", "CX1", None]
    assert keep(spark, fl.icd10_onco, vals) == ["C00", "c97 ", "D10", "D48", "B21"]


def test_f2_malignant(spark):
    assert keep(spark, lambda c: fl.icd10_onco(c, True), ["C00", "C97", "D10", "C98"]) == ["C00", "C97"]


def test_f3_old_era(spark):
    assert keep(spark, fl.icd9_malignant, ["140", "208X", "139", "209", "14", "AB1"]) == ["140", "208X"]


def test_f4_drugs(spark):
    vals = ["C999", "CX", "D09", "D37", "B21", "Z510", "Z85", "D10", "D36", "D49", "DX1", "Z52", None]
    assert keep(spark, fl.drug_onco, vals) == ["C999", "CX", "D09", "D37", "B21", "Z510", "Z85"]


def test_f5_tolerant(spark):
    codes = ["1704", "1706", "1709", "1713"]
    vals = ["1704", "17.06", "01709", " 1713 ", "1703", "1717", None]
    assert keep(spark, lambda c: fl.code_set_tolerant(c, codes), vals) == ["1704", "17.06", "01709", " 1713 "]


def test_f6_keywords(spark):
    vals = ["Apoio ao CÂNCER", "hospital", "INCA rede", "incapaz", None]
    assert keep(spark, lambda c: fl.keyword_match(c, fl.GRANT_KEYWORDS), vals) == ["Apoio ao CÂNCER", "INCA rede"]


def test_f10_active(spark):
    df = spark.createDataFrame([(" ativo ", "123"), ("ATIVO", "000000"), ("ATIVO", "359999"), ("EXTINTO", "1")],
                               "s string, m string")
    assert [r.m for r in fl.keep(df, fl.active_reference("s", "m")).collect()] == ["123"]
