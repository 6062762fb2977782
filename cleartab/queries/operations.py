"""Manifests, listings, reports and failure isolation, each over whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.operators import columns, dictionary, ingest, publish
from cleartab.plans import mortality, selection, survey_dictionary
from cleartab.queries import query, table
from cleartab.session import staging_path

_OLD = "SELECT upper('f' || p_partkey || '.dbf') AS source_file, p_size::BIGINT AS size_bytes FROM part WHERE p_partkey % 3 > 0"
_DONE = "SELECT 'F' || p_partkey || '.DBF' AS source_file, (p_size + 100)::BIGINT AS size_bytes FROM part WHERE p_partkey % 2 = 0"


@query("manifest", f"""
WITH old AS ({_OLD}), done AS ({_DONE})
SELECT source_file, size_bytes FROM old WHERE source_file NOT IN (SELECT source_file FROM done) UNION ALL SELECT * FROM done
""")
def manifest(spark, folder):
    """Entries of done files replace old ones whatever their case; a swap that stopped between its two renames
    loses none of them."""
    part, path = table(spark, folder, "part"), staging_path(spark, "manifest")
    old = part.filter("p_partkey % 3 > 0").selectExpr("'f' || p_partkey || '.dbf' AS source_file", "CAST(p_size AS BIGINT) AS size_bytes")
    publish.write_manifest(old, path)
    publish.listing.move(spark, path, f"{path}__old")
    done = part.filter("p_partkey % 2 = 0").selectExpr("'f' || p_partkey || '.DBF' AS name", "CAST(p_size + 100 AS BIGINT) AS size_bytes")
    publish.write_manifest(ingest.updated_manifest(ingest.read_manifest(spark, path), done), path)
    return ingest.read_manifest(spark, path)


@query("status", """
SELECT r_name AS unit, CASE WHEN r_regionkey = 2 THEN 'failed' ELSE 'processed' END AS status,
       CASE WHEN r_regionkey <> 2 THEN count(n_nationkey) END AS n_rows, r_regionkey = 2 AS has_error
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey
""")
def status(spark, folder):
    """One job per region; one of them fails and the others are still published."""
    nation, root = table(spark, folder, "nation"), staging_path(spark, "regions")
    units = {r.r_name: r.r_regionkey for r in table(spark, folder, "region").collect()}

    def work(unit):
        rows = nation.filter(F.col("n_regionkey") == units[unit])
        if units[unit] == 2:
            rows = rows.filter(F.raise_error(F.lit("broken input")).isNull())
        return publish.publish(rows, f"{root}/{units[unit]}")

    found = publish.isolated(spark, sorted(units), work)
    return found.select("unit", "status", "n_rows", F.col("error").isNotNull().alias("has_error"))


@query("missing_column", """
SELECT 'without' AS input, count(*) FILTER (false) AS n_rows, 18::BIGINT AS n_columns FROM orders
UNION ALL SELECT 'with', count(*) FILTER (o_orderkey % 2 = 0), 18 FROM orders
""")
def missing_column(spark, folder):
    """Records without a column the filter needs give an empty table of the full layout."""
    orders = table(spark, folder, "orders")
    rows = orders.selectExpr("CASE WHEN o_orderkey % 2 = 0 THEN '2' ELSE '1' END AS sexo", f"'DOEXT96.dbf' AS `{LINEAGE}`")
    out = None
    for name, given in (("without", rows), ("with", rows.withColumn("CAUSABAS", F.lit("X85")))):
        table_ = mortality.project(mortality.select_records(given))
        one = table_.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("input"), "n_rows", F.lit(len(table_.columns)).cast("bigint").alias("n_columns"))
        out = one if out is None else out.unionAll(one)
    return out


_CATALOG = """SELECT 't' || n_nationkey || '.parquet' AS arquivo, n_name AS diretorio, 'x' AS fontes_relacionadas,
  n_nationkey::BIGINT AS num_registros, n_regionkey::BIGINT AS num_colunas, 1::BIGINT AS tamanho_bytes, '' AS ultima_atualizacao FROM nation"""


@query("catalog_csv", f"""
SELECT row_number() OVER (ORDER BY arquivo) AS line, arquivo, diretorio, num_registros::VARCHAR AS num_registros,
       num_colunas::VARCHAR AS num_colunas FROM ({_CATALOG})
""")
def catalog_csv(spark, folder):
    """The catalog as ordered CSV, read back as one piece of text, numbered as the lines stand after the header."""
    catalog = table(spark, folder, "nation").selectExpr(
        "'t' || n_nationkey || '.parquet' AS arquivo", "n_name AS diretorio", "'x' AS fontes_relacionadas",
        "CAST(n_nationkey AS BIGINT) AS num_registros", "CAST(n_regionkey AS BIGINT) AS num_colunas",
        "CAST(1 AS BIGINT) AS tamanho_bytes", "'' AS ultima_atualizacao")
    path = staging_path(spark, "catalog")
    publish.write_catalog(catalog, path)
    # Nation is a fixed table of a few rows: one file, whose lines are numbered from its header on.
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).filter("line > 0")
    cells = F.split("value", ",")
    return lines.select("line", cells[0].alias("arquivo"), cells[1].alias("diretorio"), cells[3].alias("num_registros"),
                        cells[4].alias("num_colunas"))


@query("unlisted_columns", """
SELECT unnest(['p_brand', 'p_retailprice', 'p_type']) AS column_name WHERE (SELECT count(*) FROM part) > 0
""")
def unlisted_columns(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return columns.unlisted_columns(part, ["p_partkey", "p_name", "p_size", "p_other"])


@query("files_to_fetch", """
WITH f AS (SELECT 'doext' || (1996 + o_orderkey % 4)::INTEGER || (CASE WHEN o_orderkey % 7 = 0 THEN '.txt' ELSE '.dbf' END) AS name,
                  o_custkey::BIGINT AS size_bytes FROM orders),
one AS (SELECT name, min(size_bytes) AS size_bytes FROM f WHERE name LIKE '%.dbf' AND name < 'doext1999' GROUP BY name)
SELECT name, size_bytes FROM one WHERE name <> 'doext1996.dbf' AND NOT (name = 'doext1997.dbf' AND size_bytes = 5)
""")
def files_to_fetch(spark, folder):
    """Of the files in the year range the latest two periods are checked; the oldest is known and not looked at."""
    names = table(spark, folder, "orders").selectExpr(
        "'doext' || CAST(1996 + o_orderkey % 4 AS INT) || CASE WHEN o_orderkey % 7 = 0 THEN '.txt' ELSE '.dbf' END AS name",
        "CAST(o_custkey AS BIGINT) AS size_bytes")
    known = spark.createDataFrame([("DOEXT1996.DBF", 1), ("DOEXT1997.DBF", 5)], ingest.MANIFEST_SCHEMA)
    files = names.groupBy("name").agg(F.min("size_bytes").alias("size_bytes"))
    return selection.files_to_fetch(files, known, "DOEXT", "DBF", 1996, 1998).select("name", "size_bytes")


@query("job_survey_dictionary_files", """
WITH round AS (SELECT unnest(['2005', '2007']) AS year)
SELECT year, c_custkey::VARCHAR AS cliente, coalesce(n_name, c_nationkey::VARCHAR) AS nacao
FROM customer JOIN round ON (c_custkey % 2 = 0) = (year = '2005')
LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 4
""")
def job_survey_dictionary_files(spark, folder):
    """Two rounds from files, each with its own dictionary file; a third without a dictionary is left out, and a second
    run skips what has not changed."""
    root = staging_path(spark, "rounds")
    nation = table(spark, folder, "nation").filter("n_regionkey <> 4")
    customer = table(spark, folder, "customer").selectExpr("c_custkey", "c_nationkey")
    head = [dictionary.VAR_CODE, dictionary.VAR_TEXT, dictionary.RULE, dictionary.CAT_CODE, dictionary.CAT_TEXT]
    options = [(None, None, None, str(r.n_nationkey), r.n_name) for r in nation.select("n_nationkey", "n_name").collect()]
    sheet = [("c_custkey", "Cliente", None, "-", None), ("c_nationkey", "Nação", None, None, None), *options]
    data_files, sheets = [], []
    for year, part in (("2005", "c_custkey % 2 = 0"), ("2007", "c_custkey % 2 = 1"), ("2009", "true")):
        customer.filter(part).write.csv(f"{root}/dados_{year}", sep=";", header=True)
        data_files.append((f"dados_{year}", f"{root}/dados_{year}", 1))
        if year != "2009":
            rows = spark.createDataFrame(sheet, ", ".join(f"`{c}` string" for c in head)).coalesce(1)
            rows.write.csv(f"{root}/dic_{year}", sep=";", header=True)
            sheets.append((f"dic_{year}", f"{root}/dic_{year}", 1))
    schema = "name string, path string, size_bytes bigint"
    files = [spark.createDataFrame(f, schema) for f in (data_files, sheets)]
    seen = [sorted(r.status for r in survey_dictionary.run(spark, *files, f"{root}/manifest", f"{root}/out").collect())
            for _ in range(2)]
    if seen != [["processed"] * 2, ["skipped"] * 2]:
        raise ValueError(f"unexpected runs: {seen}")
    tables = [spark.read.parquet(f"{root}/out/{survey_dictionary.TABLE.format(year=y)}").withColumn("year", F.lit(y))
              for y in ("2005", "2007")]
    return tables[0].unionByName(tables[1]).select("year", "cliente", "nacao")
