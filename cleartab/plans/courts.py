"""Court cases: one row per document, subjects decoded, flags and outcome."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.codebooks import courts as book
from cleartab.functions import codes, dates, jsonfields, lists
from cleartab.functions.text import try_integer
from cleartab.operators import slices, versions
from cleartab.operators.publish import isolated, publish
from cleartab.session import Staging
from cleartab.sources.text import BAD_LINE, read_ndjson


def in_subset(raw: DataFrame, subset: str) -> DataFrame:
    """Documents that hold a subject of the subset and none that excludes them."""
    subjects = jsonfields.json_integers(F.col("assuntos"), "codigo")
    return raw.filter(slices.selected(subjects, book.SUBSETS[subset], book.NOT_WOMAN))


def latest_documents(raw: DataFrame, scanned: bool = False) -> DataFrame:
    """The last version of each document; documents without id stay apart."""
    return versions.latest_version(raw, ["id"], [F.col("dataHoraUltimaAtualizacao").desc()],
                                   scanned)


def with_subjects(documents: DataFrame) -> DataFrame:
    """Subject codes and names as lists, from one parse of the raw text."""
    parsed = documents.withColumn("__subjects", jsonfields.json_objects(F.col("assuntos")))
    return parsed.select(
        *documents.columns,
        jsonfields.integers_of(F.col("__subjects"), "codigo").alias("__codes"),
        jsonfields.values_of(F.col("__subjects"), "nome").alias("__labels"))


def learn_subject_names(documents: DataFrame) -> DataFrame:
    """Names by subject code, from the documents whose lists agree in length."""
    return versions.learn_names(versions.pairs_from_lists(
        documents, F.col("__codes"), F.col("__labels")))


def project(documents: DataFrame, names: DataFrame, last_year: int) -> DataFrame:
    """The published columns of documents ``with_subjects``, which carry a unique
    ``__row``. The date is computed once and used by all columns that need it."""
    staged = documents.select(
        "*",
        jsonfields.unquote(F.col("dataAjuizamento")).alias("__raw_date"),
        jsonfields.json_integer(F.col("classe"), "codigo").alias("__class"))
    staged = staged.select(
        "*",
        lists.by_priority(F.col("__codes"), book.PRIORITY, book.LAST_PRIORITY).alias("__ordered"),
        dates.within_years(dates.date_three_formats(F.col("__raw_date")),
                           book.FIRST_YEAR, last_year).alias("__date"),
        dates.year_in_number(F.col("numeroProcesso"), book.FIRST_YEAR, last_year).alias("__year"))
    staged = versions.name_lists(staged, "__row", "__ordered", names, book.NAMELESS, "__names")
    c = F.col("__codes")
    attempt = lists.has_any(c, book.ATTEMPT)
    return staged.select(
        F.col("id").alias("ID_DATAJUD"),
        F.col("numeroProcesso").alias("NUMERO_PROCESSO"),
        F.col("tribunal").alias("TRIBUNAL"),
        codes.lookup(F.col("tribunal"), book.STATE_OF_COURT).alias("UF"),
        F.col("grau").alias("GRAU"),
        F.col("__date").alias("DT_AJUIZAMENTO"),
        F.col("__raw_date").alias("DT_AJUIZAMENTO_ORIGEM"),
        dates.year_with_fallback(F.col("__date"), F.col("__year")).cast("bigint")
        .alias("ANO_AJUIZAMENTO"),
        dates.year_origin(F.col("__date"), F.col("__year"), "DATA", "NUMERO_PROCESSO")
        .alias("ORIGEM_ANO_AJUIZAMENTO"),
        F.col("__class").alias("COD_CLASSE"),
        jsonfields.json_text(F.col("classe"), "nome").alias("CLASSE"),
        lists.list_size(c).cast("bigint").alias("QTD_ASSUNTOS"),
        (lists.list_size(c) > book.PLAUSIBLE_SUBJECTS).alias("ASSUNTOS_IMPLAUSIVEL"),
        F.col("__names").alias("ASSUNTOS"),
        lists.distinct_sorted_text(c).alias("COD_ASSUNTOS"),
        lists.has_any(c, book.FEMICIDE).alias("TEM_FEMINICIDIO"),
        lists.has_any(c, book.PROTECTIVE_BREACH).alias("TEM_DESCUMPRIMENTO_PROTETIVA"),
        F.col("__class").isin(book.PROTECTIVE_CLASSES).alias("EH_MEDIDA_PROTETIVA"),
        lists.has_any(c, book.DOMESTIC_CONTEXT).alias("TEM_CONTEXTO_DOMESTICO"),
        lists.has_any(c, book.TYPIFIED).alias("TEM_VIOLENCIA_TIPIFICADA"),
        attempt.alias("TEM_CRIME_TENTADO"),
        codes.outcome(attempt, lists.has_any(c, book.DEATH_SIGN)).alias("DESFECHO"),
        jsonfields.json_integer(F.col("orgaoJulgador"), "codigo").alias("COD_ORGAO_JULGADOR"),
        jsonfields.json_text(F.col("orgaoJulgador"), "nome").alias("ORGAO_JULGADOR"),
        jsonfields.json_integer(F.col("orgaoJulgador"), "codigoMunicipioIBGE")
        .alias("COD_MUNICIPIO_IBGE"),
        jsonfields.json_text(F.col("formato"), "nome").alias("FORMATO"),
        try_integer(F.col("nivelSigilo"), "int").alias("NIVEL_SIGILO"),
        dates.timestamp_local(F.col("dataHoraUltimaAtualizacao")).alias("DT_ULTIMA_ATUALIZACAO"),
    )


def build(raw: DataFrame, last_year: int, area: Staging, scanned: bool = True) -> DataFrame:
    """Raw documents, as ``read_ndjson`` gives them, to the published table. The deduplicated and parsed documents
    are used twice, so they are staged once as Parquet; learning the names then
    reads only the two lists."""
    documents = area.table(with_subjects(latest_documents(raw, scanned)), "documents")
    # File and position identify a staged row, also after a task is repeated.
    rows = documents.withColumn("__row", F.concat_ws(
        ":", "_metadata.file_name", F.col("_metadata.row_index").cast("string")))
    return project(rows, learn_subject_names(documents), last_year)


def run(spark: SparkSession, source: str, target: str, last_year: int) -> int:
    """One subset. Lines that are no JSON are set aside in ``<target>__bad_lines``;
    the source is parsed once."""
    with Staging(spark) as area:
        raw = area.table(read_ndjson(spark, source, book.FIELDS, bad_lines=True), "raw")
        publish(raw.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE), f"{target}__bad_lines")
        good = raw.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
        return publish(build(good, last_year, area), target)


def run_subsets(spark: SparkSession, jobs: Mapping[str, tuple[str, str]], last_year: int) -> DataFrame:
    """Every subset with its own source and target; one that fails does not stop the others."""
    return isolated(spark, jobs, lambda subset: run(spark, *jobs[subset], last_year))
