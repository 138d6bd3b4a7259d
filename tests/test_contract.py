"""Dictionaries read as a contract, and what a table is told about it."""

from tabula.plans import contract as CO

from .conftest import rows

TEXT = """# D\r\n| Coluna | Tipo | Descrição |\n|---|---|---|\n| ID | texto | a \\| b |\n| ANO | inteiro | x |\n| OK | booleano | x |\n| SUMIU | texto | x |\n| ID | inteiro | again |\nText | X | y |\n"""


def test_contract(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "obitos.md").write_text(TEXT)
    (tmp_path / "d" / "outra.md").write_text("| SO | texto | x |\n")
    contract = CO.read_dictionaries(spark, str(tmp_path / "d"))
    assert sorted(rows(contract, "TABELA", "COLUNA", "TIPO")) == [
        ("obitos", "ANO", "inteiro"), ("obitos", "ID", "texto"), ("obitos", "OK", "booleano"), ("obitos", "SUMIU", "texto"), ("outra", "SO", "texto")]
    df = spark.createDataFrame([("a", 1, "Sim", "f1", 1.0), ("b", None, "?", "f1", None), ("c", None, None, "f2", None), ("a", 3, "x", None, None)],
                               "ID string, ANO int, OK string, F string, MAIS double")
    got = sorted(rows(CO.check(df, contract, "obitos", "F", {"ID": ["a", "b"], "OK": ["Sim", "Não"], "NADA": ["x"]})), key=str)
    assert got == sorted([(None, "SUMIU", "ausente", 1), (None, "F", "a mais", 1), (None, "MAIS", "a mais", 1), (None, "OK", "tipo", 1),
                          ("f2", "ANO", "sem valores", 1), ("f2", "OK", "sem valores", 1), ("f1", "OK", "fora do domínio", 1),
                          ("f2", "ID", "fora do domínio", 1), (None, "OK", "fora do domínio", 1)], key=str)
    assert CO.check(df.limit(0), contract, "obitos", "F").filter("ARQUIVO is not null").count() == 0
    assert {r["SITUACAO"] for r in CO.check(df, contract, "unknown", "F").collect()} == {"a mais"}
