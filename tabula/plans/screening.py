"""Screening tabulations: per view, decide whether the published version
changed (P9), which years to take (P10), melt the landed matrices (R1) and
replace those years in the published long table (M2).

Matrices are landed stacked in one table keyed by (VISAO, ANO); the plan is
a small (VISAO, ANO) table joined to them (semi-join), never a loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import reshape as R
from ..plans import arrival as A

# The tabulation series and the unknown-date marker.
FIRST_YEAR = 2013
UNKNOWN_DATE = "Desconhecida"

# The measures that are tabulated for each kind of exam.
MEASURES = {
    "cito_colo": ("Exames", "Exames Alterados", "ASC-US", "ASC-H", "Les IE Baixo Grau", "Les IEp Alto Grau", "Les IE AG Mic. Inv",
                  "Carc. Epiderm. Inv", "Adenocarc in situ", "Adenocarc invasor", "Outras Neoplasias"),
    "histo_colo": ("Exames", "Res_Exames_Neo_Preneo", "Neo. NIC I", "Neo. NIC II", "Neo. NIC III", "Neo. Carc. epid. Micr",
                   "Neo. Carc. epid. Inva", "Neo. Carc. epid. imp.", "Neo. Adeno in situ", "Neo. Adeno invas", "Out  NEOPL.MALIG"),
    "mamografia": ("Exames", "Mmg Diag Achados", "Mmg Diag Categoria 3", "Mmg Diag Lesao cancer", "Mmg Diag Aval QT", "Mmg Diag Revisao",
                   "Mmg Diag pos biopsia", "Assimetria Focal", "Assimetria Difusa", "Distorção Focal", "Area Densa", "Achado Benigno",
                   "Nódulo_Resul", "Microcalcificação"),
    "cito_mama": ("Exames",),
    "histo_mama": ("Exames", "Lesão benigna", "Les B_Hip duc.s/at", "Les B_Hip duc.c/at", "Les B_Hip lob.c/at", "Ben_Adnose SOE",
                   "Ben_Lesão esc. rad", "Ben_Cond fibrocíst", "Ben_Fibroadenoma", "Ben_Pap. solitário", "Ben_Pap. múltiplo",
                   "Ben_Pap. flor. mam", "Ben_Mastite", "Ben_Outros"),
}
# How the exams are named, and the two places they are counted by.
EXAMS = {"cito_colo": "Colo do útero (citopatológico)", "histo_colo": "Colo do útero (histopatológico)", "mamografia": "Mamografia",
         "cito_mama": "Mama (citopatológico)", "histo_mama": "Mama (histopatológico)"}
PLACES = {"residencia": ("Por local de residência", "UF de residencia"), "atendimento": ("Por local de atendimento", "UF do prest.serviço")}
COLUMN_DIMENSION = "Ano competencia"
_TAGS = ["EXAME", "PERFIL", "DIMENSAO_LINHA", "DIMENSAO_COLUNA"]


def view_definitions(spark: SparkSession) -> DataFrame:
    """One row for each of the ten views and its measures: (VISAO, EXAME,
    PERFIL, DIMENSAO_LINHA, DIMENSAO_COLUNA, MEDIDA, ORDEM)."""
    rows = [(f"{exam}_{place}", EXAMS[exam], profile, row, COLUMN_DIMENSION, measure, k)
            for exam, measures in MEASURES.items() for place, (profile, row) in PLACES.items() for k, measure in enumerate(measures, 1)]
    return spark.createDataFrame(rows, "VISAO string, EXAME string, PERFIL string, DIMENSAO_LINHA string, DIMENSAO_COLUNA string, "
                                       "MEDIDA string, ORDEM int")


def plan_years(views: DataFrame, manifest: DataFrame, current_year: int) -> DataFrame:
    """(VISAO, ANO) to process: views whose date changed or is unknown; the
    whole series for a view never published, else current and previous year."""
    changed = A.changed_by_signature(views, manifest, "VISAO", "DATA", "chave", "assinatura")
    changed = changed.filter(F.col("ALTERADO") | (F.col("DATA") == UNKNOWN_DATE))
    plan = A.recent_years_plan(changed, manifest, "VISAO", "chave", current_year, FIRST_YEAR)
    return plan.select("VISAO", F.col("ANO").cast("string").alias("ANO"))


def curate_screening(matrices: DataFrame, published: DataFrame | None, views: DataFrame, manifest: DataFrame,
                     current_year: int, tags: dict | None = None) -> DataFrame:
    """A view's years are replaced by those that landed; a planned year that
    did not land keeps its rows, and so does a view whose matrices hold no
    quantity at all (a failed or empty fetch)."""
    plan = plan_years(views, manifest, current_year)
    todo = matrices.join(plan, ["VISAO", "ANO"], "left_semi")
    new = R.unpivot_matrix(todo, tags, ids=["VISAO", "ANO"])
    return _replaced(published, new, todo)


def curate_views(matrices: DataFrame, published: DataFrame | None, views: DataFrame, manifest: DataFrame,
                 current_year: int, definitions: DataFrame) -> DataFrame:
    """As ``curate_screening`` for matrices of one measure each, stacked by
    (VISAO, MEDIDA, ANO): exam, profile and dimensions follow the row's view.
    Matrices of a view or a measure without a definition are left out."""
    plan = plan_years(views, manifest, current_year)
    known = definitions.select("VISAO", "MEDIDA").distinct()
    todo = matrices.join(plan, ["VISAO", "ANO"], "left_semi").join(known, ["VISAO", "MEDIDA"], "left_semi")
    long = R.unpivot_matrix(todo, ids=["VISAO", "MEDIDA", "ANO"]).drop(*_TAGS)
    tags = definitions.groupBy("VISAO").agg(*[F.min(c).alias(c) for c in _TAGS])
    new = long.join(tags, "VISAO", "left").select(*R.LONG_COLUMNS, "ANO")
    return _replaced(published, new, todo)


def _replaced(published: DataFrame | None, new: DataFrame, todo: DataFrame) -> DataFrame:
    if published is None:
        return new
    landed = todo.select("VISAO", "ANO").distinct().join(new.select("VISAO").distinct(), "VISAO", "left_semi")
    return M.merge_replace(published, new, ["VISAO", "ANO"], read_keys=landed)


def signatures_after(views: DataFrame, manifest: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """Manifest after the run: known dates recorded, unknown ones not.  With
    the run's ``new`` rows given, a view without any keeps its old signature."""
    done = views if new is None else views.join(new.select("VISAO").distinct(), "VISAO", "left_semi")
    new = done.filter(F.col("DATA") != UNKNOWN_DATE).select(F.col("VISAO").alias("chave"),
                                                            F.col("DATA").alias("assinatura"))
    return M.manifest_upsert(manifest, new, "chave")
