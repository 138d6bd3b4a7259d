"""Published tables held against their contract; the latest published period."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.domains import MORTALITY_MODERN
from ..operators import snapshots
from ..plans import contract as CO
from ..plans import mortality as MO
from ..session import staging_path
from . import curation as CU
from .registry import query

# written out here: a dictionary that lacks two columns of the table, names one that it lacks, and one with another type
_DICTIONARY = """# Dicionário

| Coluna | Tipo | Descrição |
|---|---|---|
""" + "\n".join(f"| {c} | {t} | descrição de {c} |" for c, t in [
    ("ID_REGISTRO", "texto"), ("CAUSA_BASICA", "texto"), ("CAUSA_BASICA_DESCRICAO", "texto"), ("ANO_OBITO", "texto"), ("IDADE_ANOS", "inteiro"),
    ("SEXO", "texto"), ("RACA_COR", "texto"), ("ESTADO_CIVIL", "texto"), ("LOCAL_OCORRENCIA", "texto"), ("HORA_OBITO", "texto"),
    ("COD_MUNICIPIO_RESIDENCIA", "texto"), ("ARQUIVO_ORIGEM", "texto")]) + "\n\n## Notas\n- | x | y |\n"

_SEXES = ["Masculino", "Feminino"]  # without the label of the unknown
_KNOWN = "ID_REGISTRO CAUSA_BASICA CAUSA_BASICA_DESCRICAO ANO_OBITO IDADE_ANOS SEXO RACA_COR ESTADO_CIVIL LOCAL_OCORRENCIA COD_MUNICIPIO_RESIDENCIA ARQUIVO_ORIGEM".split()
_EXTRA = ("DATA_OBITO ESCOLARIDADE OCUPACAO NATURALIDADE COD_MUNICIPIO_RESIDENCIA_ATUAL ASSISTENCIA_MEDICA OBITO_NA_GRAVIDEZ OBITO_NO_PUERPERIO "
          "DATA_NASCIMENTO ETNIA_INDIGENA COD_MUNICIPIO_OCORRENCIA TIPO_OBITO TEVE_EXAME TEVE_CIRURGIA TEVE_NECROPSIA MEDICO_ATESTANTE").split()


@query("contract_report", f"""with p as ({CU.MODERN_SQL})
select ARQUIVO_ORIGEM as ARQUIVO, 'SEXO' as COLUNA, 'fora do domínio' as SITUACAO, count(*) as N from p where SEXO not in ('Masculino', 'Feminino') group by 1
union all select ARQUIVO_ORIGEM, 'CAUSA_BASICA_DESCRICAO', 'sem valores', count(*) from p group by 1 having count(CAUSA_BASICA_DESCRICAO) = 0
union all select null, 'HORA_OBITO', 'ausente', 1 union all select null, 'ANO_OBITO', 'tipo', 1
union all select null, c, 'a mais', 1 from (select unnest([{', '.join(f"'{c}'" for c in _EXTRA)}]) as c) x""",
       ["sim_do", "ref_icd", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def contract_report(t):
    """The curated deaths against a dictionary: missing and extra columns, a
    type, and per file the values outside a domain."""
    path = staging_path(t.spark, "dicionario")
    lines = t.spark.createDataFrame([(_DICTIONARY,)], "value string")
    lines.coalesce(1).write.text(f"{path}/obitos")
    contract = CO.read_dictionaries(t.spark, path).withColumn("TABELA", F.lit("obitos"))
    deaths = MO.curate_death_records(CU._landed(t, "sim_do"), "modern", CU._refs(t))
    races = {*MORTALITY_MODERN["RACACOR"].values(), "Ignorado"}
    return CO.check(deaths, contract, "obitos", domains={"SEXO": _SEXES, "RACA_COR": races})


@query("latest_period_published", """with p as (select arquivo_origem as ARQUIVO_ORIGEM, rec_id as REC_ID, substr(dtobito, 7, 2) || substr(dtobito, 3, 2) as COMPETENCIA from rec),
f as (select *, case when COMPETENCIA >= '90' then '19' else '20' end || COMPETENCIA as ordem from p)
select ARQUIVO_ORIGEM, REC_ID, COMPETENCIA from f where ordem = (select max(ordem) from f)""", ["rec"])
def latest_period_published(t):
    """P5 over a table published by period: one partition is read."""
    path = staging_path(t.spark, "competencias")
    r = t("rec").select(F.col("arquivo_origem").alias("ARQUIVO_ORIGEM"), F.col("rec_id").alias("REC_ID"),
                        F.concat(F.substring("dtobito", 7, 2), F.substring("dtobito", 3, 2)).alias("COMPETENCIA"))
    snapshots.commit(r, path, "COMPETENCIA")
    return snapshots.read_latest(t.spark, path, lambda p: F.concat(F.when(p >= "90", "19").otherwise("20"), p))
