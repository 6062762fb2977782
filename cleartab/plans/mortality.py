"""Female deaths by assault (ICD-10 X85-Y09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.codebooks import mortality as book
from cleartab.functions.codes import lookup, split_code
from cleartab.operators.columns import ensure_columns, require_columns
from cleartab.plans import incremental

SOURCE_PREFIX, SOURCE_EXTENSION = "DOEXT", "DBF"
INPUT_COLUMNS = ["SEXO", "CAUSABAS", "DTNASC", "DTOBITO", "DTCADASTRO", "HORAOBITO", "RACACOR",
                 "ESTCIV", "CODMUNRES", "CODMUNOCOR", "LOCOCOR", "CIRCOBITO", "OBITOGRAV",
                 "OBITOPUERP"]


def select_records(rows: DataFrame) -> DataFrame:
    """Women, and a cause in the assault group; nothing when a needed column is
    missing."""
    rows = ensure_columns(require_columns(rows, ["SEXO", "CAUSABAS"]), [*INPUT_COLUMNS, LINEAGE])
    return rows.filter((F.col("SEXO") == "2") & F.col("CAUSABAS").isin(book.assault_codes()))


def project(rows: DataFrame) -> DataFrame:
    """The published columns. Dates stay text, as the source writes them."""
    method, place, aggressor = split_code(
        F.col("CAUSABAS"), book.ICD_METHOD, book.ICD_PLACE, list(book.BY_AGGRESSOR),
        book.ICD_AGGRESSOR)
    return rows.select(
        F.col("DTNASC").alias("DT_NASCIMENTO"),
        F.col("DTOBITO").alias("DT_OBITO"),
        F.col("DTCADASTRO").alias("DT_CADASTRO_OBITO"),
        F.col("HORAOBITO").alias("HORA_OBITO"),
        lookup(F.col("SEXO"), book.SEX).alias("SEXO"),
        lookup(F.col("RACACOR"), book.RACE).alias("RACA_COR"),
        lookup(F.col("ESTCIV"), book.MARITAL_STATUS).alias("EST_CIVIL"),
        F.col("CODMUNRES").alias("COD_MUNICIPIO_RESID"),
        F.col("CODMUNOCOR").alias("COD_MUNICIPIO_OBITO"),
        lookup(F.col("LOCOCOR"), book.PLACE_OF_DEATH).alias("LOCAL_OCORRENCIA_OBITO"),
        F.col("CAUSABAS").alias("CAUSA_BASICA"),
        method.alias("METODO_AGRESSAO"),
        place.alias("LOCAL_CID"),
        aggressor.alias("AGRESSOR_CID"),
        lookup(F.col("CIRCOBITO"), book.CIRCUMSTANCE).alias("TIPO_OBITO"),
        lookup(F.col("OBITOGRAV"), book.PREGNANCY).alias("GESTANTE"),
        lookup(F.col("OBITOPUERP"), book.PUERPERIUM).alias("PUERPERIO"),
        F.col(LINEAGE),
    )


def run(spark: SparkSession, source: str, target: str, manifest: str) -> DataFrame:
    """The whole job over a folder of files; see ``incremental.job``."""
    return incremental.job(spark, source, (SOURCE_PREFIX, SOURCE_EXTENSION), INPUT_COLUMNS,
                           select_records, project, target, manifest)
