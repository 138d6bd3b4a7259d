"""E1 on small files: what is planned, read, published, refused and recorded."""

import duckdb

from __spark_entry__ import oracle_sql, queries
from tabula.operators import snapshots as S
from tabula.plans import delivery as D
from tabula.plans import mortality as MO
from tabula.sources import dbf

FIELDS = [("CONTADOR", "C", 6), ("CAUSABAS", "C", 4), ("IDADE", "C", 3), ("DTOBITO", "C", 8)]
LAYOUT = "CONTADOR string, CAUSABAS string, IDADE string, DTOBITO string"


class Source:
    def __init__(self, spark, tmp_path):
        self.spark, self.at = spark, tmp_path
        (tmp_path / "chegada").mkdir()
        self.places = D.Places(*(str(tmp_path / n) for n in ("chegada", "obitos", "manifesto", "resumo")))
        self.source = D.deaths(MO.References(), LAYOUT)

    def put(self, name, *causes, cut=0):
        cols = {"CONTADOR": [str(k) for k in range(len(causes))], "CAUSABAS": list(causes), "IDADE": ["450"] * len(causes), "DTOBITO": ["01012020"] * len(causes)}
        data = dbf.dbf_bytes(cols, FIELDS)
        (self.at / "chegada" / name).write_bytes(data[: len(data) - cut])

    def run(self):
        return {r["nome"]: r["ACAO"] for r in D.run(self.spark, self.source, self.places).collect()}

    def rows(self, what="table"):
        df = S.read(self.spark, getattr(self.places, what))
        if df is None:
            return None
        key = {"table": ("ARQUIVO_ORIGEM", "CAUSA_BASICA"), "manifest": ("chave", "assinatura"),
               "summary": ("ARQUIVO", "TOTAL_OBITOS_GERAL", "TOTAL_OBITOS_CANCER")}[what]
        return sorted(tuple(r[k] for k in key) for r in df.collect())


def test_runs_of_a_source(spark, tmp_path):
    s = Source(spark, tmp_path)
    assert s.run() == {} and s.rows() is None
    s.put("DOBR2018.dbc", "C50", "A00")
    s.put("DOBR2019.dbc", "C61", "C34", "A01")
    s.put("dobr2020.dbc", "D10", cut=20)
    s.put("DOBR1990.dbc", "C50")
    s.put("other.dbc", "C50")
    assert s.run() == {"DOBR2018.dbc": "publicado", "DOBR2019.dbc": "publicado", "dobr2020.dbc": "quarentena", "DOBR1990.dbc": "outro nome", "other.dbc": "outro nome"}
    assert s.rows() == [("DOBR2018.dbc", "C50"), ("DOBR2019.dbc", "C34"), ("DOBR2019.dbc", "C61")]
    assert s.rows("summary") == [("DOBR2018.dbc", 2, 1), ("DOBR2019.dbc", 3, 2)]
    assert [k for k, _ in s.rows("manifest")] == ["DOBR2018.DBC", "DOBR2019.DBC"]
    # nothing new: only the file that could not be read is tried again, nothing is published
    assert s.run() == {"DOBR2018.dbc": "fora da janela", "DOBR2019.dbc": "inalterado", "dobr2020.dbc": "quarentena", "DOBR1990.dbc": "outro nome", "other.dbc": "outro nome"}
    assert S.version(spark, s.places.table).number == 1
    # the file is whole now; another has no oncology record left; an old one changed but is outside the window
    s.put("dobr2020.dbc", "D10")
    s.put("DOBR2019.dbc", "A01", "A02", "A03", "A04")
    s.put("DOBR2018.dbc", "C50", "C51", "C52")
    assert s.run() == {"DOBR2018.dbc": "fora da janela", "DOBR2019.dbc": "publicado", "dobr2020.dbc": "publicado", "DOBR1990.dbc": "outro nome", "other.dbc": "outro nome"}
    assert s.rows() == [("DOBR2018.dbc", "C50"), ("dobr2020.dbc", "D10")]
    assert s.rows("summary") == [("DOBR2018.dbc", 2, 1), ("DOBR2019.dbc", 4, 0), ("dobr2020.dbc", 1, 1)]
    # a file that breaks keeps its rows and its entry, and the others go on
    before = dict(s.rows("manifest"))
    s.put("dobr2020.dbc", "C50", "C51", cut=5)
    s.put("DOBR2019.dbc", "C99", "C01")
    assert s.run()["dobr2020.dbc"] == "quarentena"
    assert s.rows() == [("DOBR2018.dbc", "C50"), ("DOBR2019.dbc", "C01"), ("dobr2020.dbc", "D10")]
    after = dict(s.rows("manifest"))
    assert after["DOBR2020.DBC"] == before["DOBR2020.DBC"] and after["DOBR2019.DBC"] != before["DOBR2019.DBC"]


def test_a_run_that_is_lost_before_the_manifest_is_repeated(spark, tmp_path, monkeypatch):
    s = Source(spark, tmp_path)
    s.put("DOBR2020.dbc", "C50", "C51")
    real = S.commit
    with monkeypatch.context() as m:
        m.setattr(S, "commit", lambda rows, path, *a, **k: real(rows, path, *a, **k) if path != s.places.manifest else (_ for _ in ()).throw(OSError("lost")))
        try:
            s.run()
        except OSError:
            pass
    assert s.rows("manifest") is None and len(s.rows()) == 2
    assert s.run() == {"DOBR2020.dbc": "publicado"}
    assert len(s.rows()) == 2 and s.rows("summary") == [("DOBR2020.dbc", 2, 2)] and len(s.rows("manifest")) == 1


def test_authorization_sources_name_their_files(spark):
    names = spark.createDataFrame([("AQSP2401.dbc",), ("ARSP2401.dbc",), ("AQSP0712.dbc",), ("aqrj2402.dbc",), ("AMSP2401.dbc",), ("x.dbc",)], "n string")
    for prefix, want in (("AQ", {"AQSP2401.dbc", "aqrj2402.dbc"}), ("AR", {"ARSP2401.dbc"}), ("AM", {"AMSP2401.dbc"})):
        source = D.authorizations(prefix, None, "AP_CIDPRI string")
        assert {r["n"] for r in names.filter(source.named(names["n"])).collect()} == want
    kept = spark.createDataFrame([("C50",), ("A00",), (None,)], "AP_CIDPRI string")
    assert kept.filter(D.authorizations("AM", None, "").keep(kept)).count() == 1 and kept.filter(D.authorizations("AQ", None, "").keep(kept)).count() == 3


def delivered(spark, at, name):
    """Rows of a query and of its oracle over orders in six parts, where a join becomes a broadcast while it runs."""
    as_large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    date = "make_timestamp_ntz(cast(1995 + id div 2 % 7 as int), cast(1 + id % 12 as int), 15, 0, 0, 0)"
    spark.range(0, 1400, numPartitions=6).selectExpr("id as o_orderkey", "id % 90 as o_custkey", f"{date} as o_orderdate").write.parquet(f"{at}/orders.parquet")
    spark.range(40).selectExpr("id as p_partkey", "'p' as p_name", "'b' as p_brand", "cast(id as int) as p_size").write.parquet(f"{at}/part.parquet")
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "'n' || id as n_name").write.parquet(f"{at}/nation.parquet")
    before = {k: spark.conf.get(k, None) for k in as_large}
    try:
        for k, v in as_large.items():
            spark.conf.set(k, v)
        df = queries()[name](spark, str(at))
        got = sorted(tuple(map(str, r)) for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    con = duckdb.connect()
    for t in ("orders", "part", "nation"):
        con.execute(f"create view {t} as select * from read_parquet('{at}/{t}.parquet/*.parquet')")
    return got, sorted(tuple(map(str, r)) for r in con.execute(f"select {', '.join(df.columns)} from ({oracle_sql()[name]}) o").fetchall())


def test_the_report_of_files_whose_rows_lie_in_many_parts(spark, tmp_path):
    """F2 of round 4: every run of deliver_report goes through."""
    got, want = delivered(spark, tmp_path, "deliver_report")
    assert got == want and len(got) == 20


def test_the_summary_of_files_whose_rows_lie_in_many_parts(spark, tmp_path):
    """F3 of round 4: deliver_summary counts every record that was landed."""
    got, want = delivered(spark, tmp_path, "deliver_summary")
    assert got == want and len(got) == 6
