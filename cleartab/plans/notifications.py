"""Notified interpersonal violence against women."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.codebooks import notifications as book
from cleartab.functions import codes, dates, lists
from cleartab.operators.columns import ensure_columns, require_columns
from cleartab.plans import incremental

SOURCE_PREFIX, SOURCE_EXTENSION = "VIOLBR", "DBF"

# Input columns; older layouts lack some of them.
INPUT_COLUMNS = [
    "DT_NOTIFIC", "NU_ANO", "DT_OCOR", "HORA_OCOR", "SG_UF_NOT", "ID_MUNICIP", "TP_UNI_EXT",
    "NU_IDADE_N", "ANO_NASC", "CS_SEXO", "CS_RACA", "CS_ESCOL_N", "CS_GESTANT", "SIT_CONJUG",
    "ORIENT_SEX", "IDENT_GEN", "SG_UF", "ID_MN_RESI", "ZONA", "SG_UF_OCOR", "ID_MN_OCOR",
    "ZONA_OCOR", "LOCAL_OCOR", "OUT_VEZES", "LES_AUTOP", "NDUPLIC", "NDUPLIC_N", "VIOL_MOTIV",
    "NUM_ENVOLV", "AUTOR_SEXO", "CICL_VID_AUTOR", "AUTOR_ALCO", "REL_TRAB", "CIRC_LESAO",
    "DT_ENCERRA", "CICL_VID",
    *book.RELATIONSHIP, *book.VIOLENCE_TYPE, *book.MEANS, *book.SEXUAL_TYPE, *book.DISABILITY,
    *book.REFERRAL,
]


def select_records(rows: DataFrame) -> DataFrame:
    """Records that have the kept values and none of the dropped ones, all columns
    of the form present. Without a column of a kept value there are none."""
    whole = ensure_columns(require_columns(rows, list(book.KEPT)), [*INPUT_COLUMNS, LINEAGE])
    kept = [F.col(c) == value for c, value in book.KEPT.items()]
    return whole.filter(reduce(and_, kept + [codes.not_equal_or_null(F.col(c), v) for c, v in book.DROPPED.items()]))


def _label(column: str, labels: dict[str, str]) -> Column:
    return codes.lookup(F.col(column), labels)


def _day(column: str) -> Column:
    return dates.date_two_formats(F.col(column))


def _whole(column: str) -> Column:
    return F.col(column).try_cast("int")


def _gender() -> Column:
    """Sexual violence, sexism or an intimate partner; unknown when none of these was answered."""
    signs = (F.col("VIOL_SEXU") == "1") | F.col("VIOL_MOTIV").isin(book.SEXISM) | codes.any_marked(book.INTIMATE_PARTNER)
    return codes.three_state(signs, codes.answered(["VIOL_SEXU", *book.INTIMATE_PARTNER]))


# One rule per published column: its name (fixed, as is the order), how it is made, and of what.
RULES: list[tuple] = [
    ("DT_NOTIFICACAO", _day, "DT_NOTIFIC"),
    ("ANO_NOTIFICACAO", _whole, "NU_ANO"),
    ("DT_OCORRENCIA", _day, "DT_OCOR"),
    ("HORA_OCORRENCIA", F.col, "HORA_OCOR"),
    ("DATAS_CONSISTENTES", lambda a, b: dates.dates_consistent(_day(a), _day(b)), "DT_OCOR", "DT_NOTIFIC"),
    ("UF_NOTIFICACAO", F.col, "SG_UF_NOT"),
    ("COD_MUNICIPIO_NOTIFIC", F.col, "ID_MUNICIP"),
    ("UNIDADE_NOTIFICADORA", _label, "TP_UNI_EXT", book.NOTIFYING_UNIT),
    ("IDADE_ANOS", lambda c: codes.age_in_years(F.col(c)), "NU_IDADE_N"),
    ("IDADE_CODIGO_ORIGEM", F.col, "NU_IDADE_N"),
    ("MARCA_DUPLICIDADE_ORIGEM", F.coalesce, "NDUPLIC", "NDUPLIC_N"),
    ("ANO_NASCIMENTO", _whole, "ANO_NASC"),
    ("SEXO", _label, "CS_SEXO", book.SEX),
    ("RACA_COR", _label, "CS_RACA", book.RACE),
    ("ESCOLARIDADE", _label, "CS_ESCOL_N", book.SCHOOLING),
    ("GESTANTE", _label, "CS_GESTANT", book.PREGNANT),
    ("SITUACAO_CONJUGAL", _label, "SIT_CONJUG", book.MARITAL_STATUS),
    ("ORIENTACAO_SEXUAL", _label, "ORIENT_SEX", book.ORIENTATION),
    ("IDENTIDADE_GENERO", _label, "IDENT_GEN", book.GENDER_IDENTITY),
    ("UF_RESIDENCIA", F.col, "SG_UF"),
    ("COD_MUNICIPIO_RESID", F.col, "ID_MN_RESI"),
    ("ZONA_RESIDENCIA", _label, "ZONA", book.ZONE),
    ("UF_OCORRENCIA", F.col, "SG_UF_OCOR"),
    ("COD_MUNICIPIO_OCOR", F.col, "ID_MN_OCOR"),
    ("ZONA_OCORRENCIA", _label, "ZONA_OCOR", book.ZONE),
    ("LOCAL_OCORRENCIA", _label, "LOCAL_OCOR", book.PLACE),
    ("VIOLENCIA_DE_REPETICAO", _label, "OUT_VEZES", book.YES_NO),
    ("LESAO_AUTOPROVOCADA", _label, "LES_AUTOP", book.YES_NO_NA),
    ("VIOLENCIA_MOTIVADA_POR", _label, "VIOL_MOTIV", book.MOTIVE),
    ("TIPOS_VIOLENCIA", lists.marked_labels, book.VIOLENCE_TYPE),
    ("MEIOS_AGRESSAO", lists.marked_labels, book.MEANS),
    ("TIPOS_VIOLENCIA_SEXUAL", lists.marked_labels, book.SEXUAL_TYPE),
    ("DEFICIENCIAS", lists.marked_labels, book.DISABILITY),
    ("ENCAMINHAMENTOS", lists.marked_labels, book.REFERRAL),
    ("AGRESSOR_PARCEIRO_INTIMO", lambda names: codes.flag(codes.any_marked(names)), book.INTIMATE_PARTNER),
    ("AGRESSOR_FAMILIAR", lambda names: codes.flag(codes.any_marked(names)), book.FAMILY),
    ("INDICIO_VIOLENCIA_GENERO", _gender),
    ("NUMERO_ENVOLVIDOS", _label, "NUM_ENVOLV", book.NUMBER_INVOLVED),
    ("SEXO_AGRESSOR", _label, "AUTOR_SEXO", book.AGGRESSOR_SEX),
    ("CICLO_VIDA_AGRESSOR", lambda a, b: codes.lookup(F.coalesce(a, b), book.AGGRESSOR_LIFE_STAGE), "CICL_VID", "CICL_VID_AUTOR"),
    ("AGRESSOR_SUSPEITA_ALCOOL", _label, "AUTOR_ALCO", book.YES_NO),
    ("VIOLENCIA_RELACIONADA_TRABALHO", _label, "REL_TRAB", book.YES_NO),
    ("CID_CIRCUNSTANCIA_LESAO", F.col, "CIRC_LESAO"),
    ("DT_ENCERRAMENTO", _day, "DT_ENCERRA"),
    (LINEAGE, F.col, LINEAGE),
    ("VINCULOS_AGRESSOR", lists.marked_labels, book.RELATIONSHIP),
]


def project(rows: DataFrame) -> DataFrame:
    """The columns that have a rule, and how many relationships are marked."""
    decoded = rows.select(*[make(*parts).alias(name) for name, make, *parts in RULES])
    return decoded.withColumn("QTD_VINCULOS_AGRESSOR", F.size("VINCULOS_AGRESSOR").cast("bigint"))


def run(spark: SparkSession, source: str, target: str, manifest: str) -> DataFrame:
    """The whole job over a folder of files; see ``incremental.job``."""
    return incremental.job(spark, source, (SOURCE_PREFIX, SOURCE_EXTENSION), INPUT_COLUMNS,
                           select_records, project, target, manifest)
