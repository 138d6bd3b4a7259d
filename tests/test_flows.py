"""Invariants of the curation flows."""

from pyspark.sql import functions as F

from tabula.fixtures import Tables
from tabula.functions import columns as C
from tabula.plans import mortality as MO
from tabula.plans import outpatient as OP
from tabula.plans import surveys as SV
from tabula.queries import curation as CU
from tabula.session import staging_path
from tabula.streaming.arrival import arrival_merge

from .conftest import SMALL, one_col, rows


def test_signed_days(spark):
    got = [r[0] for r in one_col(spark, ["+12", "-3", "99999", "7", "x", None]).select(C.signed_days("v")).collect()]
    assert got == [12, -3, None, 7, None, None]


def test_personal_data_never_published(spark):
    t = Tables(spark, SMALL)
    for df in (OP.curate_panel(t("painel"), t("ref_cid10")), OP.curate_chemo(t("apac_aq"), t("ref_cid10")),
               OP.curate_drugs(t("apac_am"), t("ref_cid10"))):
        assert not {"CNS_PAC", "AP_CNSPCN"} & {c.upper() for c in df.columns}


def test_lookups_keep_row_count(spark):
    t = Tables(spark, SMALL)
    raw = CU._landed(t, "sim_do")
    kept = raw.filter(F.coalesce(F.col("CAUSABAS").isNotNull(), F.lit(False)))
    curated = MO.curate_death_records(raw, "modern", CU._refs(t))
    from tabula.operators.filters import icd10_onco, keep
    assert curated.count() == keep(C.normalize_null_tokens(raw), icd10_onco("CAUSABAS")).count()
    assert kept.count() >= curated.count()


def test_decoded_labels_within_domain(spark):
    t = Tables(spark, SMALL)
    curated = MO.curate_death_records(CU._landed(t, "sim_do"), "modern", CU._refs(t))
    labels = {r[0] for r in curated.select("SEXO").distinct().collect()}
    assert labels <= set(MO.MORTALITY_MODERN["SEXO"].values()) | {"Ignorado"}


def test_missing_cause_column_gives_empty(spark):
    t = Tables(spark, SMALL)
    raw = CU._landed(t, "sim_do").drop("CAUSABAS")
    assert MO.curate_death_records(raw, "modern").count() == 0


def test_kept_not_above_total(spark):
    t = Tables(spark, SMALL)
    s = MO.era_summary(CU._landed(t, "sim_do"), "CID10", "modern")
    assert s.filter(F.col("TOTAL_OBITOS_CANCER") > F.col("TOTAL_OBITOS_GERAL")).count() == 0


def test_survey_only_qualifying_lines(spark):
    t = Tables(spark, SMALL)
    out = SV.curate_survey(t("pns2013"), SV.CERVIX_2013)
    assert {r[0] for r in out.select("SEXO").distinct().collect()} == {"Feminino"}
    assert out.filter(F.col("ULTIMO_EXAME_PREVENTIVO") == "").count() == 0


def test_stream_rerun_without_new_files_is_idempotent(spark):
    t = Tables(spark, SMALL)
    e = t("events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("ARQUIVO_ORIGEM"))
    landing, table = staging_path(spark, "land"), staging_path(spark, "pub")
    e.write.parquet(f"{landing}/d=1")
    ck = arrival_merge(spark, landing, e.schema, table, "ARQUIVO_ORIGEM")
    first = sorted(rows(spark.read.parquet(table)))
    arrival_merge(spark, landing, e.schema, table, "ARQUIVO_ORIGEM", checkpoint=ck)
    assert sorted(rows(spark.read.parquet(table))) == first
    assert len(first) == e.count()


def test_published_column_counts(spark):
    """Widths of the published tables whose full source layout is known."""
    t = Tables(spark, SMALL)
    assert len(OP.curate_panel(t("painel"), t("ref_cid10")).columns) == 27
    expected = {"diagnosis_2013": 12, "diagnosis_2019": 25, "cervix_2013": 16, "cervix_2019": 17,
                "breast_2013": 17, "breast_2019": 17}
    for name, n in expected.items():
        edition = name.rsplit("_", 1)[1]
        assert len(SV.curate_survey(t(f"pns{edition}"), SV.SURVEYS[name]).columns) == n, name


def test_catalogue_rows_and_csv(spark, tmp_path):
    from tabula.fixtures import BASE_TABLES
    from tabula.plans import catalogue as K

    t = Tables(spark, SMALL)
    cat = K.catalogue(spark, {n: t.path(n) for n in BASE_TABLES}, {"orders.parquet": "Pedidos"})
    got = {r["ARQUIVO"]: r for r in cat.collect()}
    assert got["orders.parquet"]["NUM_REGISTROS"] == t("orders").count()
    assert got["orders.parquet"]["FONTE_RELACIONADA"] == "Pedidos"
    assert got["region.parquet"]["FONTE_RELACIONADA"] == K.UNMAPPED
    assert all(len(r["ULTIMA_ATUALIZACAO"]) == 19 for r in got.values())
    K.write_catalogue(cat, str(tmp_path / "cat"))
    assert spark.read.option("header", True).csv(str(tmp_path / "cat")).count() == len(BASE_TABLES)
    audit = K.catalogue_audit(cat).first()
    assert audit["TOTAL_ARQUIVOS"] == len(BASE_TABLES) and audit["PASTAS_NAO_MAPEADAS"] == 1


def test_screening_plan_semantics(spark):
    from tabula.plans import screening as SC

    t = Tables(spark, SMALL)
    plan = {(r.VISAO, r.ANO) for r in SC.plan_years(t("siscan_views"), t("siscan_manifest"), 2026).collect()}
    assert not any(v in ("V0", "V3") for v, _ in plan)                  # same date: skipped
    assert {a for v, a in plan if v == "V1"} == {str(y) for y in range(2013, 2027)}  # unknown date, first load
    assert {a for v, a in plan if v == "V2"} == {"2025", "2026"}         # changed: recent years only
    out = SC.curate_screening(t("siscan_mat"), t("siscan_pub"), t("siscan_views"), t("siscan_manifest"), 2026)
    old = out.filter(F.col("EXAME") == "antigo")
    assert old.filter(F.col("VISAO").isin("V1", "V4")).count() == 0
    assert old.filter((F.col("VISAO") == "V2") & F.col("ANO").isin("2025", "2026")).count() == 0
    assert old.filter(F.col("VISAO") == "V0").count() == t("siscan_pub").filter(F.col("VISAO") == "V0").count()


AUTHORIZATION = {
    "AP_CODUNI": " 2077485 ", "AP_AUTORIZ": "3524200000001", "AP_CMP": "202401", "AP_PRIPAL": "0304020010", "AP_VL_AP": "571.50",
    "AP_UFMUN": "355030", "AP_CNPJCPF": "60003761000129", "AP_CNPJMNT": "NaN", "AP_COIDADE": "4", "AP_NUIDADE": "58",
    "AP_MUNPCN": "350950", "AP_UFNACIO": "010", "AP_CEPPCN": "13010000", "AP_DTINIC": "20240101", "AP_DTFIM": "20240331",
    "AP_TPATEN": "03", "AP_CATEND": "01", "AP_CIDPRI": "C50.9", "AP_CIDSEC": "0000", "AP_CIDCAS": "", "AP_DTSOLIC": "20231220",
    "AP_DTAUT": "20231222", "AP_NATJUR": "3999", "AP_SEXO": "F", "AP_RACACOR": "77", "AP_TPAPAC": "2", "AP_CNSPCN": "700000",
}
PUBLISHED_HEADER = {
    "COD_CNES": "2077485", "NUM_APAC": "3524200000001", "ANO_MES_ATENDIMENTO": "202401", "COD_PROCEDIMENTO_PRINCIPAL": "0304020010",
    "VALOR_TOTAL_APAC": "571.50", "COD_UF_MUNICIPIO_ESTABELECIMENTO": "355030", "CNPJ_ESTABELECIMENTO": "60003761000129",
    "CNPJ_MANTENEDORA": None, "COD_TIPO_IDADE": "4", "IDADE": "58", "COD_MUNICIPIO_RESIDENCIA": "350950",
    "COD_NACIONALIDADE": "010", "CEP_PACIENTE": "13010000", "DATA_INICIO_VALIDADE": "20240101", "DATA_FIM_VALIDADE": "20240331",
    "COD_TIPO_ATENDIMENTO": "03", "COD_CARATER_ATENDIMENTO": "01", "CID_PRINCIPAL": "C50.9", "CID_SECUNDARIO": "0000",
    "CID_CAUSAS_ASSOCIADAS": None, "DATA_SOLICITACAO": "20231220", "DATA_AUTORIZACAO": "20231222", "COD_NATUREZA_JURIDICA": "3999",
    "SEXO": "Feminino", "COD_RACA_COR": "77", "RACA_COR": "77", "COD_TIPO_APAC": "2", "TIPO_APAC": "Continuidade",
}


def _one(spark, record):
    return spark.createDataFrame([tuple(record.values())], ", ".join(f"{k} string" for k in record))


def test_published_rows_of_the_three_authorization_layouts(spark):
    """Written out by hand, so a wrong name, position or label cannot pass."""
    from tabula.plans import outpatient as OP

    causes = spark.createDataFrame([("C509", "Mama, NE")], "CODIGO string, DESCRICAO string")
    tumour = {"CID10": "C50.9", "ESTADI": "3", "LINFIN": "3", "GRAHIS": "G2", "TRANTE": "S", "DTIDEN": "20230901",
              "CONTTR": "N", "DTINTR": "20240105"}
    told = {"TOPOGRAFIA_CID10": "C50.9", "TOPOGRAFIA_CID10_DESCRICAO": "Mama, NE", "COD_ESTADIAMENTO": "3", "ESTADIAMENTO": "III",
            "COD_LINFONODOS_INVADIDOS": "3", "LINFONODOS_INVADIDOS": "Não avaliáveis", "GRAU_HISTOPATOLOGICO": "G2",
            "COD_TRATAMENTO_ANTERIOR": "S", "TEVE_TRATAMENTO_ANTERIOR": "Sim", "DATA_IDENTIFICACAO_PATOLOGICA": "20230901",
            "COD_CONTINUIDADE": "N", "CONTINUIDADE_TRATAMENTO": "Não", "DATA_INICIO_TRATAMENTO": "20240105"}
    file = {"ARQUIVO_ORIGEM": "AQSP2401.dbc"}
    chemo = {**AUTHORIZATION, **{f"AQ_{k}": v for k, v in tumour.items()}, "AQ_ESQU_P1": "AC", "AQ_ESQU_P2": "T", "AQ_TOTMPL": "6",
             "AQ_TOTMAU": "3", **file}
    assert OP.curate_chemo(_one(spark, chemo), causes).first().asDict() == {
        **PUBLISHED_HEADER, **told, "ESQUEMA_TERAPEUTICO_INICIO": "AC", "ESQUEMA_TERAPEUTICO_FIM": "T", "TOTAL_MESES_PLANEJADOS": "6",
        "TOTAL_MESES_AUTORIZADOS": "3", **file}
    radio = {**AUTHORIZATION, **{f"AR_{k}": v for k, v in tumour.items()}, "AR_FINALI": "4", **file}
    assert OP.curate_radio(_one(spark, radio), causes).first().asDict() == {
        **PUBLISHED_HEADER, **told, "COD_FINALIDADE": "4", "FINALIDADE_RADIOTERAPIA": "Paliativa", **file}
    drugs = {**AUTHORIZATION, "AM_PESO": "70", "AM_ALTURA": "165", "AM_GESTANT": "N", **file}
    assert OP.curate_drugs(_one(spark, drugs), causes).first().asDict() == {
        **PUBLISHED_HEADER, "CID_PRINCIPAL_DESCRICAO": "Mama, NE", "PESO_KG": "70", "ALTURA_CM": "165", "GESTANTE": "Não", **file}


def test_screening_view_definitions(spark):
    from tabula.plans import screening as SC

    rows = SC.view_definitions(spark).collect()
    count = {}
    for r in rows:
        count[r["VISAO"]] = count.get(r["VISAO"], 0) + 1
    each = {"cito_colo": 11, "histo_colo": 11, "mamografia": 14, "cito_mama": 1, "histo_mama": 14}
    assert count == {f"{exam}_{place}": n for exam, n in each.items() for place in ("residencia", "atendimento")}
    assert {(r["PERFIL"], r["DIMENSAO_LINHA"]) for r in rows if r["VISAO"].endswith("atendimento")} == {("Por local de atendimento", "UF do prest.serviço")}
    # a first load: tags follow the view, unknown views and measures are left out
    cube = spark.createDataFrame([("mamografia_residencia", "Nódulo_Resul", "2025", "35 SP", "1.200", "9"), ("mamografia_residencia", "ASC-US", "2025", "35 SP", "1", "9"),
                                  ("outra", "Exames", "2025", "35 SP", "1", "9"), ("histo_mama_atendimento", "Exames", "2014", " total ", "1", "9")],
                                 "VISAO string, MEDIDA string, ANO string, linha string, `2025` string, Total string")
    dates = spark.createDataFrame([(v, "2025-01") for v in (*count, "outra")], "VISAO string, DATA string")
    none = spark.createDataFrame([], "chave string, assinatura string")
    out = SC.curate_views(cube, None, dates, none, 2026, SC.view_definitions(spark)).collect()
    assert [r.asDict() for r in out] == [{"VISAO": "mamografia_residencia", "EXAME": "Mamografia", "PERFIL": "Por local de residência",
        "DIMENSAO_LINHA": "UF de residencia", "CATEGORIA_LINHA": "35 SP", "DIMENSAO_COLUNA": "Ano competencia", "CATEGORIA_COLUNA": "2025",
        "MEDIDA": "Nódulo_Resul", "QTD": 1200, "ANO": "2025"}]
    # what is recorded after the run (upper-cased keys) is known to the next one
    seen = SC.signatures_after(dates, none)
    assert SC.plan_years(dates.withColumn("DATA", F.lit("2025-02")), seen, 2026).select("ANO").distinct().count() == 2


def test_survey_fields_are_cut_once(spark):
    """each field is stripped once, whatever uses it, and near fields come from one piece of the line."""
    from tabula.plans import surveys as SV

    sv = SV.SURVEYS["diagnosis_2019"]
    line = [" "] * 1060
    for pos, text in ((1, "35"), (104, "\t7"), (108, "2"), (117, "045"), (120, "4"), (1031, "1"), (1032, "1"), (1037, "é"), (1046, "9"), (1049, "2")):
        line[pos - 1 : pos - 1 + len(text)] = text
    lines = spark.createDataFrame([("".join(line),), ("".join(line)[:1036],), (None,), ("1",)], "value string")
    got = SV.curate_survey(lines, sv)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= len(sv.layout) + 2  # the fields and the filter
    whole, short = sorted((r.asDict() for r in got.collect()), key=lambda r: r["TIPO_OUTRO"], reverse=True)
    assert (whole["COD_UF"], whole["NUM_ORDEM_MORADOR"], whole["SEXO"], whole["IDADE"], whole["COR_RACA"]) == ("35", "7", "Feminino", 45, "Parda")
    assert (whole["TIPO_PELE"], whole["TIPO_MAMA"], whole["TIPO_OUTRO"], whole["TIPO_BEXIGA"]) == ("Sim", "é", "Ignorado", "")
    assert short["TIPO_PELE"] == "Sim" and short["TIPO_MAMA"] == "" and short["LIMITACAO_ATIVIDADES"] == ""
