"""Survey rounds recoded by the data dictionary that comes with each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.operators import columns, dictionary, ingest, publish
from cleartab.sources.text import read_delimited

# Fixed value: name of the published tables.
TABLE = "pn_violencia_domestica_{year}"


def sheet_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary delivered as one small CSV file: rows numbered in file order.
    Cells may hold line breaks, so the file is read as a whole."""
    rows = read_delimited(spark, path, multiline=True)
    return rows.withColumn("row_no", F.monotonically_increasing_id())


def recode(data: DataFrame, sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(table, unlisted)``: the recoded table, and the columns the dictionary does
    not name (kept as they are)."""
    variables, categories = dictionary.read_dictionary(sheet)
    names = dictionary.collect_names(variables)
    return (dictionary.apply_dictionary(data, names, categories),
            columns.unlisted_columns(data, list(names)))


def run(spark: SparkSession, data_files: DataFrame, dictionary_files: DataFrame,
        manifest_path: str, folder: str) -> DataFrame:
    """All rounds that have both files and changed since the last run; each is its
    own table with its own columns, so each is its own job. Returns the status
    per round; rounds published are marked as done even if others failed."""
    pairs = ingest.pair_by_year(data_files, dictionary_files).filter("status = 'paired'")
    files = data_files.unionByName(dictionary_files)
    manifest = ingest.read_manifest(spark, manifest_path)
    parts = (pairs.select("year", F.explode(F.array("data_file", "dict_file")).alias("name"))
             .join(files, "name"))
    changed = ingest.groups_to_process(parts, manifest, "year")
    rounds = {r.year: r for r in pairs.join(changed, "year").collect()}  # one row per round
    paths = {r.name: r.path for r in parts.collect()}

    def work(year: str) -> int:
        one = rounds[year]
        data = read_delimited(spark, paths[one.data_file])
        table, _ = recode(data, sheet_from_csv(spark, paths[one.dict_file]))
        return publish.publish(table, f"{folder}/{TABLE.format(year=year)}")

    todo = sorted(y for y, r in rounds.items() if r.changed)
    status = publish.isolated(spark, todo, work)
    skipped = [(y, "skipped", None, None) for y in sorted(set(rounds) - set(todo))]
    status = status.unionAll(spark.createDataFrame(skipped, status.schema))
    done = parts.join(status.filter("status = 'processed'"), F.col("year") == F.col("unit"),
                      "left_semi").select("name", "size_bytes")
    if todo:
        publish.write_manifest(ingest.updated_manifest(manifest, done), manifest_path)
    return status
