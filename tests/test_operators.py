"""Edge rows and invariants for joins, reshape, merge and planning."""

import pytest
from pyspark.sql import functions as F

from tabula.operators import lookups as L
from tabula.operators import merge as M
from tabula.operators import reshape as R
from tabula.operators.policy import order_columns
from tabula.plans import arrival as A

from .conftest import rows


def test_lookup_conditional(spark):
    fact = spark.createDataFrame([("835",), ("010",), ("899",), (None,)], "nat string")
    uf = spark.createDataFrame([("35", "SP")], "codigo string, descricao string")
    pais = spark.createDataFrame([("010", "Brasil")], "codigo string, descricao string")
    out = L.lookup_conditional(fact, "nat", uf, pais, out="lbl")
    assert sorted(rows(out, "nat", "lbl"), key=str) == sorted(
        [("835", "SP"), ("010", "Brasil"), ("899", None), (None, None)], key=str)


def test_synonym_resolve_keeps_rows(spark):
    fact = spark.createDataFrame([("100001",), ("200000",), (None,)], "m string")
    syn = spark.createDataFrame([("100001", "100501"), ("100001", "100502")], "a string, b string")
    out = L.synonym_resolve(fact, "m", syn, "a", "b", "cur")
    assert out.count() == 3  # duplicate synonym keys never multiply rows
    assert sorted(rows(out, "m", "cur"), key=str) == sorted(
        [("100001", "100501"), ("200000", "200000"), (None, None)], key=str)


def test_fanout_audit(spark):
    d = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(L.duplicate_keys(d, "k")) == [("a", 2)]
    with pytest.raises(ValueError):
        L.assert_unique(d, "k")


def test_range_list_explode(spark):
    df = spark.createDataFrame([("358001-358003, 000001-000202, 12-345, 7, x, ",)], "s string")
    got = [r.codigo for r in R.range_list_explode(df, "s").orderBy("_pos", "_subpos").collect()]
    assert got == ["358001", "358002", "358003", "000007"]


def test_synonym_map_last_writer(spark):
    cad = spark.createDataFrame([
        ("100001", "ATIVO", "200000, 300000", 1),
        ("100002", " ativo ", "200000", 2),          # later row wins for 200000
        ("100003", "EXTINTO", "400000", 3),          # inactive
        ("000000", "ATIVO", "500000", 4),            # not real
        ("100005", "ATIVO", "100005, 129999", 5),    # old == current, *9999 excluded
    ], "m string, s string, syn string, o int")
    out = R.synonym_map(cad, "m", "s", "syn", "o")
    assert sorted(rows(out)) == [("200000", "100002"), ("300000", "100001")]


def test_unpivot_matrix(spark):
    m = spark.createDataFrame([("a", "1.234", "0", "5"), (" Total ", "9", "9", "9"), ("b", "", "-", "2")],
                              "linha string, y2019 string, y2020 string, Total string")
    out = R.unpivot_matrix(m, {"VISAO": "v"})
    assert sorted(rows(out, "CATEGORIA_LINHA", "CATEGORIA_COLUNA", "QTD", "VISAO")) == [("a", "y2019", 1234, "v")]


def _pub(spark):
    return spark.createDataFrame([(1, "A.dbc"), (2, "B.dbc"), (3, None), (4, "C.dbc")], "id int, ARQUIVO_ORIGEM string")


def test_merge_replace_file(spark):
    pub = _pub(spark)
    new = spark.createDataFrame([(10, "B.dbc")], "id int, ARQUIVO_ORIGEM string")
    read = spark.createDataFrame([("B.dbc",), ("C.dbc",)], "ARQUIVO_ORIGEM string")  # C read, zero rows kept
    once = M.merge_replace(pub, new, "ARQUIVO_ORIGEM", read)
    assert sorted(rows(once, "id")) == [(1,), (3,), (10,)]
    twice = M.merge_replace(once, new, "ARQUIVO_ORIGEM", read)
    assert sorted(rows(twice)) == sorted(rows(once))  # idempotent


def test_summary_upsert_precedence(spark):
    schema = "ANO int, FONTE string, ARQUIVO string, N long"
    old = spark.createDataFrame([(2020, "CID10", "DOBR2020.dbc", 5), (2021, "PRELIM", "DOPR21.dbc", 1),
                                 (None, "CID9", "X.dbc", 1)], schema)
    new = spark.createDataFrame([(2020, "PRELIM", "DOPR20.dbc", 9), (2021, "PRELIM", "DOPR21.dbc", 2),
                                 (None, "CID9", "X.dbc", 3)], schema)
    out = sorted(rows(M.summary_upsert(old, new)), key=str)
    assert out == sorted([(2020, "CID10", "DOBR2020.dbc", 5), (2021, "PRELIM", "DOPR21.dbc", 2),
                          (None, "CID9", "X.dbc", 3)], key=str)


def test_publish_partitioned_rewrites_only_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    M.publish_partitioned(_pub(spark).filter("ARQUIVO_ORIGEM is not null"), path, "ARQUIVO_ORIGEM")
    M.publish_partitioned(spark.createDataFrame([(20, "B.dbc")], "id int, ARQUIVO_ORIGEM string"), path,
                          "ARQUIVO_ORIGEM")
    assert sorted(rows(spark.read.parquet(path), "id", "ARQUIVO_ORIGEM")) == [(1, "A.dbc"), (4, "C.dbc"), (20, "B.dbc")]


def test_two_digit_year_and_recency(spark):
    df = spark.createDataFrame([("79",), ("78",), ("90",), ("89",)], "yy string")
    got = rows(df.select(A.two_digit_year(F.col("yy"), 79), A.two_digit_year(F.col("yy"), 90)))
    assert got == [(1979, 2079), (2078, 2078), (1990, 1990), (1989, 2089)]
    names = spark.createDataFrame([("DORBR95.dbc",), ("DOBR2001.dbc",), ("README",)], "n string")
    assert [r[0] for r in names.select(A.recency_key("n")).collect()] == ["1995", "2001", "README"]


def test_dedupe_case_insensitive(spark):
    df = spark.createDataFrame([("aqSP0801.dbc", 1), ("AQSP0801.dbc", 2), ("x.txt", 3)], "nome string, doc_id int")
    assert rows(A.dedupe_case_insensitive(df, "nome", "doc_id")) == [("AQSP0801.dbc", 2)]


def _read(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "ARQUIVO_ORIGEM string")


def test_publish_replacing_drops_emptied_files(spark, tmp_path):
    path = str(tmp_path / "r")
    M.publish_partitioned(_pub(spark).filter("ARQUIVO_ORIGEM is not null"), path, "ARQUIVO_ORIGEM")
    batch = spark.createDataFrame([(30, "A.dbc")], "id int, ARQUIVO_ORIGEM string")
    M.publish_replacing(batch, path, "ARQUIVO_ORIGEM", _read(spark, "A.dbc", "C.dbc"))  # C read, nothing kept
    assert sorted(rows(spark.read.parquet(path), "id", "ARQUIVO_ORIGEM")) == [(2, "B.dbc"), (30, "A.dbc")]


def test_sum_all_null_and_ratio(spark):
    from tabula.operators import rollups as RO

    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), ("b", None)], "k string, v double")
    assert sorted(rows(df.groupBy("k").agg(RO.sum_all_null("v").alias("s")))) == [("a", None), ("b", 2.0)]
    r = spark.createDataFrame([(3, 7), (1, 0), (None, 5), (2, None)], "kept long, total long")
    assert [x[0] for x in r.select(RO.ratio("kept", "total")).collect()] == [0.4286, None, None, None]


def test_occupation_vocabularies(spark):
    from tabula.plans import references as RF

    old = spark.createDataFrame([("7", " Pedreiro ", 1), ("12", "Pintor", 2)], "CODIGO string, DESCRICAO string, ordem int")
    new = spark.createDataFrame([("00700", "Pedreiro de obras", 1), (" ", "x", 2)], "CODIGO string, DESCRICAO string, ordem int")
    got = sorted(rows(RF.occupations(new, old)))
    assert got == [("007", "Pedreiro"), ("00700", "Pedreiro de obras"), ("012", "Pintor"), ("01200", "Pintor")]


def test_lookups_start_no_job_and_carry_no_hint(spark):
    fact = spark.range(0, 3000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id"))
    dim = spark.createDataFrame([(str(i), f"L{i}") for i in range(5)], "codigo string, descricao string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    out = L.lookup_label(fact, F.col("k"), dim, "codigo", "descricao", "lbl")
    out = L.enrich_found_flag(out, "k", dim, "codigo", "achou", columns=["descricao"])
    out = M.merge_replace(out, out.limit(5), "k")
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_summary_upsert_reads_each_input_once(spark, tmp_path):
    cols = "ANO int, FONTE string, ARQUIVO string, N long"
    old = [(2001, "PRELIM", "a", 1), (2002, "CID10", "b", 2), (None, "CID9", "x", 3), (None, "CID9", "y", 4)]
    new = [(2001, "PRELIM", "a2", 5), (2002, "PRELIM", "b2", 6), (2003, "ZZ", "c", 7), (None, "CID9", "x", 8)]
    for name, data in (("old", old), ("new", new)):
        spark.createDataFrame(data, cols).write.parquet(str(tmp_path / name))
    out = M.summary_upsert(*[spark.read.parquet(str(tmp_path / n)) for n in ("old", "new")])
    assert sorted(rows(out), key=str) == sorted(
        [(2001, "PRELIM", "a2", 5), (2002, "CID10", "b", 2), (2003, "ZZ", "c", 7), (None, "CID9", "x", 8), (None, "CID9", "y", 4)], key=str)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Scan parquet") == 2


def test_published_keys_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "typed")
    df = spark.createDataFrame([(1, "2024"), (2, "0007")], "id int, ANO string")
    M.publish_replacing(df, path, "ANO", df)
    assert sorted(rows(M.read_published(spark, path, df.schema))) == [(1, "2024"), (2, "0007")]


def test_rejected_ranges_are_reported(spark):
    df = spark.createDataFrame([("358001-358003, 000001-000202, 12-345, 9-1, 7, x, ",)], "s string")
    got = sorted((r["parte"], r["motivo"]) for r in R.rejected_ranges(df, "s").collect())
    assert got == [("000001-000202", "too wide"), ("12-345", "widths differ"), ("9-1", "descending")]
    short = spark.createDataFrame([("1234-1236, 123",)], "s string")  # a range keeps its own width
    assert [r.codigo for r in R.range_list_explode(short, "s").orderBy("_pos", "_subpos").collect()] == ["1234", "1235", "1236", "000123"]


def test_published_order_is_a_stable_sort_by_place():
    names = ["z", "ARQ", "b", "B", "y", "fim", "drop", "a"]
    assert order_columns(names, ["DROP"], [["A", "c"], ["B"]], ["FIM"], ["arq"]) == ["a", "b", "z", "y", "fim", "ARQ"]


def test_old_era_keeps_the_cause_it_found(spark):
    from tabula.plans import mortality as MO

    raw = spark.createDataFrame([("1749", "F1"), ("400", "F1")], "CAUSABAS_O string, ARQUIVO_ORIGEM string")
    out = MO.curate_death_records(raw, "old")
    assert rows(out) == [("1749", "F1")] and "CAUSA_BASICA" in out.columns


def test_empty_preliminary_table_carries_the_schema(spark):
    from tabula.plans import mortality as MO

    raw = spark.createDataFrame([("C50", "F1")], "CAUSABAS string, ARQUIVO_ORIGEM string")
    out = MO.curate_preliminary(spark, None, MO.References(), None, raw)
    assert out.count() == 0 and out.schema == MO.curate_death_records(raw).schema


def test_odd_values_give_null_not_an_error(spark):
    from tabula.functions import columns as C

    df = spark.createDataFrame([("12345678901",), ("+12",), ("-3",), ("x",)], "d string")
    assert [r[0] for r in df.select(C.signed_days("d")).collect()] == [None, 12, -3, None]
    assert [r[0] for r in df.select(A.two_digit_year(F.col("d"), 79)).collect()] == [None, 2012, 1997, None]
    nums = spark.createDataFrame([(12345678.9,), (5.0,), (0.1,), (1e22,), (None,)], "v double")
    assert [r[0] for r in nums.select(C.integral_float_text("v")).collect()] == ["12345678.9", "5", "0.1", "1" + "0" * 22, None]


def test_registry_columns_outside_the_list_never_reach_the_output(spark):
    from tabula.plans import facilities as FA

    hab = spark.createDataFrame([("123", "1704", "P1", "202001")], "CNES string, SGRUPHAB string, PORTARIA string, DTPORTAR string")
    reg = spark.createDataFrame([("123", "Nome", "motivo", "cpf")], "CO_CNES string, NO_FANTASIA string, CO_MOTIVO_DESAB string, NU_CPF string")
    out = FA.curate_facilities(hab, reg, None)
    assert "NOME_FANTASIA" in out.columns and not {"CO_MOTIVO_DESAB", "NU_CPF"} & set(out.columns)


def test_screening_keeps_history_of_what_did_not_land(spark):
    from tabula.plans import screening as SC

    views = spark.createDataFrame([("V1", "2026-01"), ("V2", "2026-01")], "VISAO string, DATA string")
    manifest = spark.createDataFrame([("V1", "old"), ("V2", "old")], "chave string, assinatura string")
    mats = spark.createDataFrame([("V1", "2026", "a", "5"), ("V2", "2026", "a", "0")], "VISAO string, ANO string, linha string, click string")
    cols = SC.R.LONG_COLUMNS
    pub = spark.createDataFrame([(v, *["x"] * 7, 1, y) for v in ("V1", "V2") for y in ("2025", "2026")],
                                ", ".join(f"{c} {'long' if c == 'QTD' else 'string'}" for c in cols) + ", ANO string")
    out = SC.curate_screening(mats, pub, views, manifest, 2026)
    got = sorted((r["VISAO"], r["ANO"], r["QTD"]) for r in out.collect())
    assert got == [("V1", "2025", 1), ("V1", "2026", 5), ("V2", "2025", 1), ("V2", "2026", 1)]
    new = SC.R.unpivot_matrix(mats, None, ids=["VISAO", "ANO"])
    assert sorted(rows(SC.signatures_after(views, manifest, new))) == [("V1", "2026-01"), ("V2", "old")]


def test_filename_attributes_and_control_files(spark):
    from tabula.operators.filters import not_control_file

    df = spark.createDataFrame([("AQSP0801.dbc",), ("arrj0712.DBC",), ("HBSP2401.dbc",), ("_manifest.json",)], "n string")
    got = rows(df.select(*A.authorization_attributes("n")))
    assert got[0] == ("AQ", "SP", 2008, 1, True)
    assert got[1] == ("AR", "RJ", 2007, 12, False)      # before 2008: not valid
    assert got[2] == (None, None, None, None, False)    # other prefix
    assert [r[0] for r in df.filter(not_control_file("n")).collect()] == ["AQSP0801.dbc", "arrj0712.DBC", "HBSP2401.dbc"]


def test_strip_date_prefix_and_latest_period(spark):
    df = spark.createDataFrame([("20240131_AQSP2401.dbc",), ("AQSP9912.dbc",), ("AQRJ2401.dbc",)], "nome string")
    assert [r[0] for r in df.select(A.strip_date_prefix("nome")).collect()] == \
        ["AQSP2401.dbc", "AQSP9912.dbc", "AQRJ2401.dbc"]
    clean = df.select(A.strip_date_prefix("nome").alias("nome"))
    latest = sorted(r.nome for r in A.latest_period_slice(clean, A.period_of("nome")).collect())
    assert latest == ["AQRJ2401.dbc", "AQSP2401.dbc"]  # 2024-01 beats 1999-12 (no text-max trap)


def test_publish_replacing_replay_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "replay")
    M.publish_partitioned(_pub(spark).filter("ARQUIVO_ORIGEM is not null"), path, "ARQUIVO_ORIGEM")
    batch = spark.createDataFrame([(30, "A.dbc"), (31, "A.dbc")], "id int, ARQUIVO_ORIGEM string")
    M.publish_replacing(batch, path, "ARQUIVO_ORIGEM", _read(spark, "A.dbc", "C.dbc"))
    once = sorted(rows(spark.read.parquet(path), "id", "ARQUIVO_ORIGEM"))
    M.publish_replacing(batch, path, "ARQUIVO_ORIGEM", _read(spark, "A.dbc", "C.dbc"))  # the same batch replayed
    assert sorted(rows(spark.read.parquet(path), "id", "ARQUIVO_ORIGEM")) == once == \
        [(2, "B.dbc"), (30, "A.dbc"), (31, "A.dbc")]


def test_catalogue_of_empty_unreadable_and_other_files(spark, tmp_path):
    from tabula.plans import catalogue as K

    spark.createDataFrame([], "a int, b string").coalesce(1).write.parquet(str(tmp_path / "vazia"))
    (tmp_path / "ruim").mkdir()
    (tmp_path / "ruim" / "x.parquet").write_bytes(b"not parquet")
    (tmp_path / "ruim" / "y.csv").write_text("a;b")
    cat = K.catalogue(spark, {"v": str(tmp_path / "vazia"), "r": str(tmp_path / "ruim")}, {"y.csv": "Só este"},
                      {"ruim": "Fonte 1 | Fonte 2"}, {"y.csv": "texto"}, descriptions_by_folder={"ruim": "da pasta"})
    got = {(r["DIRETORIO"], r["ARQUIVO"][-9:]): r for r in cat.collect()}
    empty = next(r for (d, _), r in got.items() if d == "vazia")
    assert (empty["NUM_REGISTROS"], empty["NUM_COLUNAS"], empty["FONTE_RELACIONADA"]) == (0, 2, K.UNMAPPED)
    bad, other = got["ruim", "x.parquet"], got["ruim", "y.csv"]
    assert bad["NUM_REGISTROS"] is None and (bad["FONTE_RELACIONADA"], bad["DESCRICAO"]) == ("Fonte 1", "da pasta")
    assert other["NUM_REGISTROS"] is None and (other["FONTE_RELACIONADA"], other["DESCRICAO"]) == ("Só este", "texto")
    assert K.catalogue_audit(cat).first()["ARQUIVOS_SEM_METADADOS"] == 2
    K.write_catalogue(cat, str(tmp_path / "csv"))
    data = next((tmp_path / "csv").glob("*.csv")).read_bytes()
    assert data.startswith("\ufeffARQUIVO".encode())
