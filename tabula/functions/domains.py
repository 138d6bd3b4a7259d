"""Domain decoding: coded values -> readable labels.

Decoding is a literal-map lookup (``element_at(map, key)``): the map is a
constant folded into the plan, so decode stays inside whole-stage codegen and
never calls Python per row.  Domains are plain dicts below.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _c, is_blank, zero_pad

IGNORED = "Ignorado"
YES, NO = "Sim", "Não"


def literal_map(domain: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in itertools.chain.from_iterable(domain.items())])


def lookup(domain: dict, key: Column) -> Column:
    """Label of ``key`` or null (null key -> null)."""
    return F.try_element_at(literal_map(domain), key)


def decode_else_default(c, domain: dict, default: str = IGNORED) -> Column:
    """Trimmed code -> label; unknown or null -> ``default``."""
    return F.coalesce(lookup(domain, F.trim(_c(c))), F.lit(default))


def decode_keep_unknown(c, domain: dict, strip_zeros: bool = False) -> Column:
    """Trimmed code -> label; unknown keeps the trimmed code; null -> null.
    ``strip_zeros`` matches ``01`` against ``1`` (all-zero codes kept)."""
    t = F.trim(_c(c))
    key = F.coalesce(F.nullif(F.ltrim(t, F.lit("0")), F.lit("")), t) if strip_zeros else t
    return F.coalesce(lookup(domain, key), t)


def decode_pair(c, domain: dict, code_name: str, label_name: str, **kw) -> list[Column]:
    """D3: the raw (trimmed) code and its label, as two output columns."""
    return [F.trim(_c(c)).alias(code_name), decode_keep_unknown(c, domain, **kw).alias(label_name)]


def decode_blank_empty(c, domain: dict) -> Column:
    """D4 (surveys): blank -> ``""``; known -> label; unknown kept as is."""
    c = _c(c)
    t = F.trim(c)
    return F.when(is_blank(c), F.lit("")).otherwise(F.coalesce(lookup(domain, t), t))


def decode_padded(c, domain: dict, width: int) -> Column:
    """Zero-pad the trimmed code to ``width`` then decode, keeping the
    padded code when unknown; null stays null."""
    padded = zero_pad(F.trim(_c(c)), width)
    return F.coalesce(lookup(domain, padded), padded)


# Flag spellings read as yes / no.
YES_TOKENS = ["1", "1.0", "S", "SIM", "TRUE", "T"]
NO_TOKENS = ["0", "0.0", "N", "NAO", "NÃO", "FALSE", "F"]


def flag_yes_no(c) -> Column:
    """yes/no spellings -> ``Sim`` / ``Não``; anything else null."""
    v = F.upper(F.trim(_c(c)))
    return F.when(v.isin(YES_TOKENS), F.lit(YES)).when(v.isin(NO_TOKENS), F.lit(NO))


def multi_decode(columns: dict, domain: dict, how=decode_keep_unknown) -> list[Column]:
    """One domain over many columns ``{source: output}``."""
    return [how(src, domain).alias(out) for src, out in columns.items()]


def decode_by_era(c, era: str, field: str, default: str = IGNORED) -> Column:
    """The same field decodes with a different table per era."""
    return decode_else_default(c, ERA_DOMAINS[era][field], default)


# ---------------------------------------------------------------------------
# Domain tables of the published sources (code -> label).
# ---------------------------------------------------------------------------

MORTALITY_MODERN = {
    "TIPOBITO": {"1": "Fetal", "2": "Não fetal"},
    "SEXO": {"0": "Ignorado", "1": "Masculino", "2": "Feminino", "M": "Masculino", "F": "Feminino", "I": "Ignorado"},
    "RACACOR": {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena"},
    "ESTCIV": {"1": "Solteiro", "2": "Casado", "3": "Viúvo", "4": "Separado judicialmente/divorciado", "5": "União estável"},
    "ESTCIVIL": {"1": "Solteiro", "2": "Casado", "3": "Viúvo", "4": "Separado judicialmente/divorciado", "5": "União estável"},
    "ESC": {"1": "Nenhuma", "2": "1 a 3 anos", "3": "4 a 7 anos", "4": "8 a 11 anos", "5": "12 e mais", "8": "9 a 11 anos"},
    "ESCMAE": {"1": "Nenhuma", "2": "1 a 3 anos", "3": "4 a 7 anos", "4": "8 a 11 anos", "5": "12 e mais"},
    "ESC2010": {"0": "Sem escolaridade", "1": "Fundamental I (1ª a 4ª série)", "2": "Fundamental II (5ª a 8ª série)",
                "3": "Médio (antigo 2º grau)", "4": "Superior incompleto", "5": "Superior completo"},
    "ESCMAE2010": {"0": "Sem escolaridade", "1": "Fundamental I (1ª a 4ª série)", "2": "Fundamental II (5ª a 8ª série)",
                   "3": "Médio (antigo 2º grau)", "4": "Superior incompleto", "5": "Superior completo"},
    "ESCFALAGR1": {"00": "Sem escolaridade", "01": "Fundamental I incompleto", "02": "Fundamental I completo",
                   "03": "Fundamental II incompleto", "04": "Fundamental II completo", "05": "Ensino Médio incompleto",
                   "06": "Ensino Médio completo", "07": "Superior incompleto", "08": "Superior completo",
                   "10": "Fundamental I incompleto ou inespecífico", "11": "Fundamental II incompleto ou inespecífico",
                   "12": "Ensino Médio incompleto ou inespecífico"},
    "ESCMAEAGR1": {"00": "Sem escolaridade", "01": "Fundamental I incompleto", "02": "Fundamental I completo",
                   "03": "Fundamental II incompleto", "04": "Fundamental II completo", "05": "Ensino Médio incompleto",
                   "06": "Ensino Médio completo", "07": "Superior incompleto", "08": "Superior completo",
                   "10": "Fundamental I incompleto ou inespecífico", "11": "Fundamental II incompleto ou inespecífico",
                   "12": "Ensino Médio incompleto ou inespecífico"},
    "LOCOCOR": {"1": "Hospital", "2": "Outro estabelecimento de saúde", "3": "Domicílio", "4": "Via pública",
                "5": "Outros", "6": "Aldeia indígena"},
    "ASSISTMED": {"1": "Com assistência", "2": "Sem assistência"},
    "ATESTANTE": {"1": "Sim, atendeu ao falecido", "2": "Substituto", "3": "Instituto Médico Legal",
                  "4": "Serviço de Verificação de Óbitos", "5": "Outros"},
    "EXAME": {"1": "Sim", "2": "Não"},
    "CIRURGIA": {"1": "Sim", "2": "Não"},
    "NECROPSIA": {"1": "Sim", "2": "Não"},
    "ACIDTRAB": {"1": "Sim", "2": "Não"},
    "OBITOGRAV": {"1": "Sim", "2": "Não"},
    "OBITOPUERP": {"1": "Sim, até 42 dias após o parto", "2": "Sim, de 43 dias a 1 ano", "3": "Não"},
    "GRAVIDEZ": {"1": "Única", "2": "Dupla", "3": "Tripla e mais"},
    "GESTACAO": {"1": "Menos de 22 semanas", "2": "22 a 27 semanas", "3": "28 a 31 semanas", "4": "32 a 36 semanas",
                 "5": "37 a 41 semanas", "6": "42 semanas e mais"},
    "PARTO": {"1": "Vaginal", "2": "Cesáreo"},
    "OBITOPARTO": {"1": "Antes", "2": "Durante", "3": "Depois"},
    "TPMORTEOCO": {"1": "Na gravidez", "2": "No parto", "3": "No aborto", "4": "Até 42 dias após o parto",
                   "5": "De 43 dias a 1 ano após o parto", "8": "Não ocorreu nestes períodos"},
    "CIRCOBITO": {"1": "Acidente", "2": "Suicídio", "3": "Homicídio", "4": "Outros"},
    "FONTE": {"1": "Ocorrência policial", "2": "Hospital", "3": "Família", "4": "Outra"},
    "FONTEINV": {"1": "Comitê de Morte Materna e/ou Infantil", "2": "Visita domiciliar/Entrevista família",
                 "3": "Estabelecimento de Saúde/Prontuário", "4": "Relacionamento com outros bancos de dados",
                 "5": "Serviço de Verificação de Óbitos", "6": "Instituto Médico Legal", "7": "Outra fonte",
                 "8": "Múltiplas fontes"},
    "TPPOS": {"1": "Sim", "2": "Não"},
    "ALTCAUSA": {"1": "Sim", "2": "Não"},
    "STDOEPIDEM": {"1": "Sim", "0": "Não"},
    "STDONOVA": {"1": "Sim", "0": "Não"},
    "TPNIVELINV": {"E": "Estadual", "R": "Regional", "M": "Municipal"},
    "MORTEPARTO": {"1": "Antes", "2": "Durante", "3": "Após"},
    "TPRESGINFO": {"01": "Não acrescentou nem corrigiu informação", "02": "Permitiu resgate de novas informações",
                   "03": "Permitiu correção de causa informada"},
    "TPOBITOCOR": {"1": "Durante a gestação", "2": "Durante o abortamento", "3": "Após o abortamento",
                   "4": "No parto ou até 1h após", "5": "No puerpério (até 42 dias)", "6": "Entre 43 dias e 1 ano",
                   "7": "Investigação não identificou o momento", "8": "Mais de um ano após o parto",
                   "9": "Não ocorreu nas circunstâncias anteriores"},
}

# Panel of oncology cases.
PANEL_TREATMENT = {"1": "Cirurgia", "2": "Quimioterapia", "3": "Radioterapia",
                   "4": "Quimioterapia + Radioterapia", "5": "Sem informação de tratamento"}
PANEL_CATEGORY = {"1": "Neoplasias malignas (Lei 12.732/12)", "2": "Neoplasias in situ",
                  "3": "Neoplasias de comportamento incerto ou desconhecido", "4": "C44 e C73"}
PANEL_STAGE = {"0": "0", "1": "I", "2": "II", "3": "III", "4": "IV", "5": "Não se aplica", "9": "Ignorado"}
PANEL_SEX = {"F": "Feminino", "M": "Masculino"}

# Outpatient authorizations (race codes 03/04 are the reverse of mortality's 3/4).
AUTH_SEX = {"1": "Masculino", "M": "Masculino", "2": "Feminino", "F": "Feminino"}
AUTH_RACE = {"01": "Branca", "02": "Preta", "03": "Parda", "04": "Amarela", "05": "Indígena", "99": "Sem informação"}
AUTH_YES_NO = {"S": "Sim", "N": "Não"}
AUTH_NODES = {"S": "Sim", "N": "Não", "3": "Não avaliáveis"}
AUTH_STAGE = {"0": "0", "1": "I", "2": "II", "3": "III", "4": "IV"}
AUTH_TYPE = {"1": "Inicial", "2": "Continuidade", "3": "Única"}
AUTH_RADIO_PURPOSE = {"1": "Radical", "2": "Adjuvante", "3": "Antiálgica", "4": "Paliativa", "5": "Prévia",
                      "6": "Antihemorrágica"}

# Work-related cancer notifications.
WORK_SEX = {"M": "Masculino", "F": "Feminino", "I": "Ignorado"}
WORK_RACE = {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena", "9": "Ignorado"}
WORK_PREGNANCY = {"1": "1º trimestre", "2": "2º trimestre", "3": "3º trimestre", "4": "Idade gestacional ignorada",
                  "5": "Não", "6": "Não se aplica", "9": "Ignorado"}
WORK_SCHOOLING = {"00": "Analfabeto", "01": "1ª a 4ª série incompleta do EF", "02": "4ª série completa do EF",
                  "03": "5ª à 8ª série incompleta do EF", "04": "Ensino fundamental completo",
                  "05": "Ensino médio incompleto", "06": "Ensino médio completo", "07": "Educação superior incompleta",
                  "08": "Educação superior completa", "09": "Ignorado", "10": "Não se aplica"}
WORK_EMPLOYMENT = {"01": "Empregado registrado com carteira assinada", "02": "Empregado não registrado",
                   "03": "Autônomo/conta própria", "04": "Servidor público estatutário",
                   "05": "Servidor público celetista", "06": "Aposentado", "07": "Desempregado",
                   "08": "Trabalho temporário", "09": "Cooperativado", "10": "Trabalhador avulso",
                   "11": "Empregador", "12": "Outros", "99": "Ignorado"}
WORK_TIME_UNIT = {"1": "Hora", "2": "Dia", "3": "Mês", "4": "Ano"}
WORK_OUTSOURCED = {"1": "Sim", "2": "Não", "3": "Não se aplica", "9": "Ignorado"}
WORK_REGIME = {"1": "Hospitalar", "2": "Ambulatorial"}
WORK_EXPOSURE = {"1": "Sim", "2": "Não", "9": "Ignorado"}
WORK_SMOKING = {"1": "Sim", "2": "Não", "3": "Ex-fumante", "9": "Ignorado"}
WORK_YES_NO_IGN = {"1": "Sim", "2": "Não", "9": "Ignorado"}
WORK_OUTCOME = {"1": "Sem evidência da doença (remissão completa)", "2": "Remissão parcial", "3": "Doença estável",
                "4": "Doença em progressão", "5": "Fora de possibilidade terapêutica",
                "6": "Óbito por câncer relacionado ao trabalho", "7": "Óbito por outras causas",
                "8": "Não se aplica", "9": "Ignorado"}

# Facilities: oncology qualification codes (label, paediatric).
ONCO_QUALIFICATIONS = {
    "1704": ("Serviço Isolado de Radioterapia", False),
    "1705": ("Serviço Isolado de Quimioterapia/Oncologia Clínica", False),
    "1706": ("UNACON - Unidade de Assistência de Alta Complexidade em Oncologia", False),
    "1707": ("UNACON com Serviço de Radioterapia", False),
    "1708": ("UNACON com Serviço de Hematologia", False),
    "1709": ("UNACON com Serviço de Oncologia Pediátrica", True),
    "1710": ("UNACON Exclusiva de Hematologia", False),
    "1711": ("UNACON Exclusiva de Oncologia Pediátrica", True),
    "1712": ("CACON - Centro de Assistência de Alta Complexidade em Oncologia", False),
    "1713": ("CACON com Serviço de Oncologia Pediátrica", True),
    "1714": ("Hospital Geral com Cirurgia Oncológica", False),
    "1715": ("Serviço de Radioterapia de Complexo Hospitalar", False),
    "1716": ("Serviço de Oncologia Clínica de Complexo Hospitalar", False),
}

# Facilities: unit type (two-digit code).
UNIT_TYPE = {
    "01": "Posto de Saúde", "02": "Centro de Saúde / Unidade Básica", "04": "Policlínica", "05": "Hospital Geral",
    "07": "Hospital Especializado", "15": "Unidade Mista", "20": "Pronto Socorro Geral",
    "21": "Pronto Socorro Especializado", "36": "Clínica / Centro de Especialidade",
    "39": "Unidade de Serviço de Apoio de Diagnose e Terapia (SADT)",
    "40": "Unidade de Apoio Diagnose e Terapia (SADT Isolado)",
    "42": "Unidade Móvel de Nível Pré-Hospitalar (Urgência/Emergência)", "43": "Farmácia",
    "45": "Unidade de Saúde da Família", "50": "Unidade de Vigilância em Saúde",
    "60": "Cooperativa ou Empresa de Cessão de Trabalhadores na Saúde", "61": "Centro de Parto Normal Isolado",
    "62": "Hospital / Dia", "67": "Laboratório Central de Saúde Pública (LACEN)",
    "69": "Centro de Atenção Hemoterápica e/ou Hematológica", "70": "Centro de Atenção Psicossocial",
    "71": "Centro de Apoio à Saúde da Família", "72": "Unidade de Atenção à Saúde Indígena",
    "73": "Pronto Atendimento", "74": "Polo Academia da Saúde", "76": "Central de Regulação Médica das Urgências",
    "80": "Laboratório de Saúde Pública", "81": "Central de Regulação do Acesso",
}

# Death records of the old era (1979-1995): other labels for the same fields.
MORTALITY_OLD = {
    "TIPOBITO": {"1": "Fetal", "2": "Não fetal"},
    "SEXO": {"1": "Masculino", "2": "Feminino"},
    "ESTCIVIL": {"1": "Solteiro", "2": "Casado", "3": "Viúvo", "4": "Separado judicialmente/divorciado", "5": "União estável"},
    "INSTRUCAO": {"1": "Nenhuma", "2": "Primeiro grau", "3": "Segundo grau", "4": "Superior"},
    "LOCOCOR": {"1": "Hospital", "2": "Via pública", "3": "Domicílio", "4": "Outro"},
    "TIPOGRAV": {"1": "Única", "2": "Dupla", "3": "Tríplice", "4": "Mais de 3"},
    "TIPOPARTO": {"1": "Espontâneo", "2": "Operatório", "3": "Fórceps", "4": "Outro"},
    "ASSISTMED": {"1": "Com assistência médica", "2": "Sem assistência médica"},
    "ATESTANTE": {"1": "Sim, atendeu ao falecido", "2": "Substituto", "3": "Instituto Médico Legal",
                  "4": "Serviço de Verificação de Óbitos", "5": "Outro"},
    "EXAME": {"1": "Sim", "2": "Não"},
    "CIRURGIA": {"1": "Sim", "2": "Não"},
    "NECROPSIA": {"1": "Sim", "2": "Não"},
    "ACIDTRAB": {"1": "Sim", "2": "Não"},
    "TIPOVIOL": {"1": "Homicídio", "2": "Suicídio", "3": "Acidente", "4": "Outros tipos de violência"},
    "TIPOACID": {"1": "Atropelamento", "2": "Demais acidentes de trânsito", "3": "Queda", "4": "Afogamento",
                 "5": "Outros tipos de acidente"},
    "FONTINFO": {"1": "Boletim de ocorrência", "2": "Hospital", "3": "Outro"},
    "LOCACID": {"1": "Via pública", "2": "Domicílio", "3": "Outro", "4": "Local de trabalho"},
}

ERA_DOMAINS: dict[str, dict[str, dict]] = {"modern": MORTALITY_MODERN, "old": MORTALITY_OLD}
