"""Municipalities with their health regions and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.functions.text import zero_pad
from cleartab.operators.publish import publish
from cleartab.operators.relational import left_join_on
from cleartab.sources.text import read_delimited

KEY_WIDTH = 6


def join_regions(regions: DataFrame, geo: DataFrame) -> DataFrame:
    """All columns of both tables but the right key; keys get their lost zeros back."""
    left = regions.withColumn("cod_municipio", zero_pad(F.col("cod_municipio"), KEY_WIDTH))
    right = geo.withColumn("MUNCOD", zero_pad(F.col("MUNCOD"), KEY_WIDTH))
    return left_join_on(left, right, "cod_municipio", "MUNCOD")


def run(spark: SparkSession, regions_csv: str, geo_csv: str, target: str) -> int:
    return publish(join_regions(read_delimited(spark, regions_csv),
                                read_delimited(spark, geo_csv)), target)
