"""Catalog of the published files: rows, columns, size and sources per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.operators import ingest, publish
from cleartab.sources import listing


def build(spark: SparkSession, root: str, sources: DataFrame, catalog_name: str = "") -> DataFrame:
    """``sources(folder, name, position)`` names the sources of each folder. Rows
    and columns come from Parquet footers; an unreadable file keeps its entry."""
    files = ingest.data_files(listing.list_files(spark, root),
                              [catalog_name, "_SUCCESS"] if catalog_name else ["_SUCCESS"])
    footers = listing.parquet_footers(files.filter(F.col("name").endswith(".parquet")))
    names = publish.names_by_folder(sources)
    joined = files.join(footers, "path", "left").join(names, "folder", "left")
    return joined.select(
        F.col("key").alias("arquivo"),
        F.col("folder").alias("diretorio"),
        F.coalesce("names", F.lit(publish.UNMAPPED)).alias("fontes_relacionadas"),
        F.col("n_rows").alias("num_registros"),
        F.col("n_columns").alias("num_colunas"),
        F.col("size_bytes").alias("tamanho_bytes"),
        F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("ultima_atualizacao"))


def totals(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count(F.lit(1)).alias("n_files"),
                       F.coalesce(F.sum("num_registros"), F.lit(0)).alias("n_rows"))


def unmapped_folders(catalog: DataFrame) -> DataFrame:
    return (catalog.filter(F.col("fontes_relacionadas") == publish.UNMAPPED)
            .select("diretorio").distinct())


def unreadable(catalog: DataFrame) -> DataFrame:
    return catalog.filter(F.col("arquivo").endswith(".parquet")
                          & F.col("num_registros").isNull()).select("arquivo")


def run(spark: SparkSession, root: str, sources: DataFrame, target: str) -> None:
    publish.write_catalog(build(spark, root, sources), target)
