"""Scans, sinks, streaming and whole jobs, on files derived from the test tables.

Input values are written as SQL expressions that Spark and the checking engine
evaluate alike, so both sides start from the same records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.codebooks import courts as court_book
from cleartab.codebooks import mortality as death_book
from cleartab.codebooks import notifications as form_book
from cleartab.codebooks import survey as survey_book
from cleartab.functions import jsonfields, lists
from cleartab.operators import publish as sinks
from cleartab.plans import (catalog, courts, geography, incremental, mortality, notifications,
                            raw_store, survey_dictionary, survey_fixed)
from cleartab.queries import query, table
from cleartab.queries.dbf_files import put_bytes, write_dbf
from cleartab.queries.values import CALENDAR
from cleartab.session import Staging, staging_path
from cleartab.sources import text as scans
from cleartab.sources.dbf import read_dbf
from cleartab.streaming import documents as stream


def sql_map(book: dict) -> str:
    def show(x):
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return "MAP {" + ", ".join(f"{show(k)}: {show(v)}" for k, v in book.items()) + "}"


def written(df: DataFrame, name: str, fmt: str = "parquet", **options) -> str:
    path = staging_path(df.sparkSession, name)
    df.write.format(fmt).options(**options).save(path)
    return path


# ---- scans -------------------------------------------------------------------

_LINE = ("rpad(CAST(c_custkey AS STRING), 8, ' ') || rpad(c_mktsegment, 12, ' ') || "
         "lpad(CAST(c_custkey % 100 AS STRING), 3, '0') || CASE WHEN c_custkey % 10 = 3 THEN repeat(' ', 14) "
         "ELSE lpad(CAST(c_custkey * 12345678 % 9999999999 AS STRING), 14, '0') END")


@query("scan_fixed_width", """
SELECT c_custkey::VARCHAR AS id, c_mktsegment AS segment, lpad((c_custkey % 100)::VARCHAR, 3, '0') AS age,
       CASE WHEN c_custkey % 10 = 3 THEN '' ELSE lpad((c_custkey * 12345678 % 9999999999)::VARCHAR, 14, '0') END AS weight
FROM customer
""")
def scan_fixed_width(spark, folder):
    path = written(table(spark, folder, "customer").selectExpr(f"{_LINE} AS value"), "lines", "text")
    return scans.read_fixed_width(spark, path, {"id": (0, 8), "segment": (8, 20), "age": (20, 23), "weight": (23, 37)})


@query("scan_delimited", """
SELECT p_partkey::VARCHAR AS p_partkey, 'say "' || p_name || '"; ok' AS p_name, p_brand,
       CASE WHEN p_size <= 10 THEN NULL ELSE p_size::VARCHAR END AS p_size, false AS bad FROM part
UNION ALL SELECT p_partkey::VARCHAR, p_name, NULL, NULL, false FROM part
UNION ALL SELECT '3', 'x', '4', 'EXTRA', true
""")
def scan_delimited(spark, folder):
    """Files of two column orders, one of them without some columns, and a line with one cell too many."""
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey", """'say "' || p_name || '"; ok' AS p_name""", "p_brand",
        "CASE WHEN p_size <= 5 THEN 'NA' WHEN p_size > 10 THEN CAST(p_size AS STRING) END AS p_size")
    path = written(rows, "parts", "csv", sep=";", header=True, escape='"')
    table(spark, folder, "part").select("p_name", "p_partkey").write.mode("append").csv(path, sep=";", header=True)
    broken = spark.createDataFrame([("p_partkey;p_brand;p_name;p_size",), ("3;x;4;EXTRA;MORE",)], "value string")
    broken.coalesce(1).write.mode("append").text(path)
    read = scans.read_delimited(spark, path, bad_lines=True)
    cells = F.split(scans.BAD_LINE, ";")
    bad = F.col(scans.BAD_LINE).isNotNull()
    return read.select(
        "p_partkey", F.when(bad, cells[1]).otherwise(F.col("p_name")).alias("p_name"),
        F.when(bad, cells[2]).otherwise(F.col("p_brand")).alias("p_brand"), "p_size", bad.alias("bad"))


@query("scan_ndjson", """
SELECT event_id::VARCHAR AS id, event_type AS kind, json_extract_string(props, '$.k') AS k,
       CASE WHEN event_type = 'click' THEN NULL ELSE user_id::VARCHAR END AS who
FROM events
""")
def scan_ndjson(spark, folder):
    rows = table(spark, folder, "events").selectExpr(
        "event_id AS id", "event_type AS kind", "from_json(props, 'k int') AS props",
        "CASE WHEN event_type <> 'click' THEN user_id END AS who")
    path = written(rows.filter("kind = 'view'").selectExpr("*", "1 AS extra"), "raw", "json")
    sinks.append_ndjson(rows.filter("kind <> 'view'"), path)
    raw = scans.read_ndjson(spark, path, ["id", "kind", "props", "who"])
    return raw.select("id", "kind", jsonfields.json_text(F.col("props"), "k").alias("k"), "who")


@query("scan_parquet_union", """
SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS balance, true AS has_file FROM customer WHERE c_acctbal <= 3000
UNION ALL SELECT c_custkey, NULL, c_acctbal, true FROM customer WHERE c_acctbal > 3000
""")
def scan_parquet_union(spark, folder):
    rows = table(spark, folder, "customer")
    a = written(rows.filter("c_acctbal <= 3000").selectExpr("c_custkey AS id", "c_name AS name"), "a")
    b = written(rows.filter("c_acctbal > 3000").selectExpr("c_custkey AS id", "c_acctbal AS balance"), "b")
    both = scans.read_parquet_union(spark, [a, b], lineage=True)
    return both.select("id", "name", "balance", F.col(LINEAGE).endswith(".parquet").alias("has_file"))


_DBF = [("ID", "N", 12), ("NAME", "C", 20), ("BALANCE", "N", 14), ("DAY", "D", 8), ("FLAG", "L", 1)]


@query("scan_dbf", """
SELECT c_custkey::VARCHAR AS "ID", CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END AS "NAME",
       CASE WHEN c_nationkey = 5 THEN NULL WHEN c_nationkey % 2 = 0 THEN floor(abs(c_acctbal))::BIGINT::VARCHAR
            ELSE (floor(abs(c_acctbal)) + 0.5)::DOUBLE::VARCHAR END AS "BALANCE",
       CASE WHEN c_nationkey = 7 THEN NULL ELSE '2020-02-28' END AS "DAY",
       CASE WHEN c_nationkey < 8 THEN 'True' WHEN c_nationkey < 16 THEN 'False' END AS "FLAG", true AS from_file
FROM customer
""")
def scan_dbf(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS ID", "CASE WHEN c_nationkey = 3 THEN '' ELSE c_name END AS NAME",
        "CASE WHEN c_nationkey = 5 THEN '***' WHEN c_nationkey % 2 = 0 THEN CAST(floor(abs(c_acctbal)) AS STRING) || '.00' "
        "ELSE CAST(floor(abs(c_acctbal)) AS STRING) || '.5' END AS BALANCE",
        "CASE WHEN c_nationkey = 7 THEN '00000000' ELSE '20200228' END AS DAY",
        "CASE WHEN c_nationkey < 8 THEN 'T' WHEN c_nationkey < 16 THEN 'n' ELSE '?' END AS FLAG")
    # A file for every hundred thousand customers, three at least.
    number = F.concat(F.lit("DOEXT"), F.pmod(F.xxhash64("ID"), F.lit(max(3, rows.count() // 100_000))).cast("string"), F.lit(".dbf"))
    files = write_dbf(rows, staging_path(spark, "dbf"), _DBF, number)
    read = read_dbf(spark, [(path, size) for path, _, size in files], split=20_000)
    return read.select(*[f[0] for f in _DBF], F.col(LINEAGE).startswith("DOEXT").alias("from_file"))


# ---- sinks and streaming -----------------------------------------------------

_OLD = "SELECT o_orderkey, o_totalprice, 'ORD' || year(o_orderdate) || '.dbc' AS _ARQUIVO_ORIGEM FROM orders"
_REPLACED = f"""
WITH old AS ({_OLD}) SELECT *, NULL AS mark FROM old WHERE _ARQUIVO_ORIGEM NOT IN ('ORD1996.dbc', 'ORD1998.dbc', 'ORD2000.dbc')
UNION ALL SELECT o_orderkey, o_totalprice * 2, {{name}}, 'R' FROM old
WHERE _ARQUIVO_ORIGEM IN ('ORD1996.dbc', 'ORD2000.dbc') AND o_totalprice > 1000"""


def _old_and_batch(spark, folder):
    old = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "'ORD' || year(o_orderdate) || '.dbc' AS _ARQUIVO_ORIGEM")
    new = old.filter("_ARQUIVO_ORIGEM IN ('ORD1996.dbc', 'ORD2000.dbc') AND o_totalprice > 1000").withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "mark": F.lit("R")})
    return old, new


@query("publish_replacing", _REPLACED.format(name="lower(_ARQUIVO_ORIGEM)"))
def publish_replacing(spark, folder):
    """Replace three of seven source files on disk, twice (the second run changes
    nothing); one file yields no rows, the others are spelled in lower case."""
    old, new = _old_and_batch(spark, folder)
    path = staging_path(spark, "published")
    sinks.publish_replacing(old, path, [f"ORD{y}.dbc" for y in range(1990, 2010)])
    batch = new.withColumn(LINEAGE, F.lower(LINEAGE))
    for _ in range(2):
        sinks.publish_replacing(batch, path, ["ord1996.dbc", "ord1998.dbc", "ord2000.dbc"])
    return sinks.read_published(spark, path)


@query("publish_swapped", _REPLACED.format(name="_ARQUIVO_ORIGEM"))
def publish_swapped(spark, folder):
    """The same replacement in one flat table that the plan reads and overwrites."""
    old, new = _old_and_batch(spark, folder)
    path = staging_path(spark, "flat")
    sinks.publish(old, path)
    sinks.recover(spark, path)
    merged = sinks.replace_by_source(spark.read.parquet(path), new, ["ORD1996.dbc", "ORD1998.dbc", "ORD2000.dbc"])
    sinks.publish_swapped(merged, path)
    return spark.read.parquet(path)


@query("multi_output", """
SELECT 'rich' AS output, c_custkey AS id, c_mktsegment AS detail FROM customer WHERE c_acctbal > 7000
UNION ALL SELECT 'building', c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def multi_output(spark, folder):
    root = staging_path(spark, "outputs")
    sinks.multi_output(
        table(spark, folder, "customer"),
        {"rich": (F.col("c_acctbal") > 7000, lambda d: d.selectExpr("c_custkey AS id", "c_mktsegment AS detail")),
         "building": (F.col("c_mktsegment") == "BUILDING", lambda d: d.selectExpr("c_custkey AS id", "c_name AS detail"))},
        lambda df, name: sinks.publish(df, f"{root}/{name}"))
    rich, building = (spark.read.parquet(f"{root}/{n}").withColumn("output", F.lit(n)) for n in ("rich", "building"))
    return rich.unionByName(building)


@query("catalog_files", """
SELECT 'parties' AS folder, 'Customers | Suppliers' AS sources, 8::BIGINT AS n_columns,
       (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n_rows, true AS sized
UNION ALL SELECT 'goods', '(não mapeado)', 6, (SELECT count(*) FROM part), true
""")
def catalog_files(spark, folder):
    root = staging_path(spark, "bucket")
    for name, place in (("customer", "parties"), ("supplier", "parties"), ("part", "goods")):
        sinks.publish(table(spark, folder, name), f"{root}/{place}/{name}")
    sources = spark.createDataFrame([("parties", "Suppliers", 2), ("parties", "Customers", 1)],
                                    "folder string, name string, position int")
    files = catalog.build(spark, root, sources)
    per_table = files.groupBy("diretorio", "fontes_relacionadas", F.element_at(F.split("arquivo", "/"), 2).alias("t")).agg(
        F.max("num_colunas").alias("c"), F.sum("num_registros").alias("r"), F.min("tamanho_bytes").alias("s"))
    out = per_table.groupBy(F.col("diretorio").alias("folder"), F.col("fontes_relacionadas").alias("sources")).agg(
        F.sum("c").alias("n_columns"), F.sum("r").alias("n_rows"), (F.min("s") > 0).alias("sized"))
    return out.select("folder", "sources", F.when(F.col("folder") == "parties", F.col("n_columns") - 1)
                      .otherwise(F.col("n_columns")).alias("n_columns"), "n_rows", "sized")


@query("stream_latest", """
SELECT 'u' || user_id AS id, event_type AS kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, event_id::VARCHAR AS event
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S') DESC, event_id::VARCHAR DESC) = 1
UNION ALL SELECT '{"id":"b","seen"', 'bad line', NULL, '3'
""")
def stream_latest(spark, folder):
    """Three arrivals of files, each taken in once, the last under a new checkpoint and each with a broken
    line; the store gives the latest version over all, and the broken lines are counted."""
    fields = ["id", "seen", "event", "kind"]
    rows = table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"), F.col("event_id").cast("string").alias("event"),
        F.col("event_type").alias("kind"))
    first, second, store = (staging_path(spark, n) for n in ("arrivals", "later", "store"))
    order = [F.col("seen").desc(), F.col("event").desc()]
    one, two = (staging_path(spark, n) for n in ("progress", "new_progress"))
    for part, path, checkpoint in (("kind = 'view'", first, one), ("kind = 'click'", first, one),
                                   ("kind NOT IN ('view', 'click')", second, two)):
        sinks.append_ndjson(rows.filter(part), path)
        spark.range(1).selectExpr("""'{"id":"b","seen"' AS value""").write.mode("append").text(path)
        stream.ingest(spark, path, store, checkpoint, fields, ["id"], order)
    bad = stream.bad_lines(spark, store).groupBy(F.col(stream.BAD_LINE).alias("id")).agg(F.count("*").alias("n"))
    return stream.current(spark, store, fields, ["id"], order).unionByName(
        bad.select("id", F.lit("bad line").alias("kind"), F.lit(None).cast("string").alias("seen"),
                   F.col("n").cast("string").alias("event")))


# ---- jobs --------------------------------------------------------------------

_K = "o_orderkey"
DEATHS = {
    "SEXO": f"CASE {_K} % 5 WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE '2' END",
    "CAUSABAS": f"CASE {_K} % 3 WHEN 0 THEN 'X' || CAST(84 + {_K} % 16 AS STRING) ELSE 'Y0' || CAST({_K} % 10 AS STRING) END "
                f"|| CASE WHEN {_K} % 7 = 0 THEN '' ELSE CAST({_K} % 11 AS STRING) END",
    "DTNASC": "CAST(o_orderdate AS STRING)", "DTOBITO": "o_orderpriority", "DTCADASTRO": "o_orderstatus", "HORAOBITO": "'1015'",
    "RACACOR": f"CAST({_K} % 10 AS STRING)", "ESTCIV": f"CAST({_K} % 9 AS STRING)",
    "CODMUNRES": f"CAST({_K} AS STRING)", "CODMUNOCOR": "CAST(o_custkey AS STRING)", "LOCOCOR": f"CAST({_K} % 8 AS STRING)",
    "CIRCOBITO": f"CASE WHEN {_K} % 4 > 0 THEN CAST({_K} % 4 AS STRING) END", "OBITOGRAV": f"CAST({_K} % 3 AS STRING)",
    "OBITOPUERP": f"CAST({_K} % 5 AS STRING)",
    LINEAGE: "'DOEXT' || CAST(year(o_orderdate) AS STRING) || '.dbc'",
}
DEATHS["DTNASC"] = f"CAST({_K} % 28 AS STRING)"
_DEATH_SQL = ", ".join(f'{e} AS "{c}"' for c, e in DEATHS.items())


def _label(book: dict, column: str, name: str) -> str:
    return f"{sql_map(book)}[{column}] AS {name}"


_DEATHS_DECODED = f"""
SELECT DTNASC AS DT_NASCIMENTO, DTOBITO AS DT_OBITO, DTCADASTRO AS DT_CADASTRO_OBITO, HORAOBITO AS HORA_OBITO,
  {_label(death_book.SEX, 'SEXO', 'SEXO')}, {_label(death_book.RACE, 'RACACOR', 'RACA_COR')},
  {_label(death_book.MARITAL_STATUS, 'ESTCIV', 'EST_CIVIL')}, CODMUNRES AS COD_MUNICIPIO_RESID, CODMUNOCOR AS COD_MUNICIPIO_OBITO,
  {_label(death_book.PLACE_OF_DEATH, 'LOCOCOR', 'LOCAL_OCORRENCIA_OBITO')}, CAUSABAS AS CAUSA_BASICA,
  {_label(death_book.ICD_METHOD, 'CAUSABAS[1:3]', 'METODO_AGRESSAO')},
  CASE WHEN CAUSABAS[1:3] NOT IN ('Y06', 'Y07') THEN {sql_map(death_book.ICD_PLACE)}[CAUSABAS[4]] END AS LOCAL_CID,
  CASE WHEN CAUSABAS[1:3] IN ('Y06', 'Y07') THEN {sql_map(death_book.ICD_AGGRESSOR)}[CAUSABAS[4]] END AS AGRESSOR_CID,
  {_label(death_book.CIRCUMSTANCE, 'CIRCOBITO', 'TIPO_OBITO')}, {_label(death_book.PREGNANCY, 'OBITOGRAV', 'GESTANTE')},
  {_label(death_book.PUERPERIUM, 'OBITOPUERP', 'PUERPERIO')}, _ARQUIVO_ORIGEM
FROM (SELECT {_DEATH_SQL} FROM orders) WHERE SEXO = '2' AND (
  regexp_full_match(CAUSABAS, '(X8[5-9]|X9[0-9]|Y0[0-589])[0-9]?') OR regexp_full_match(CAUSABAS, 'Y06[01289]?|Y07[012389]?'))
"""


@query("job_mortality", _DEATHS_DECODED)
def job_mortality(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e in DEATHS.items()])
    raw = incremental.from_parquet(spark, [written(rows, "deaths")])
    batch = raw.transform(mortality.select_records).transform(mortality.project)
    path = staging_path(spark, "mortality")
    sinks.publish_replacing(batch, path, [f"DOEXT{y}.dbc" for y in range(1990, 2010)])
    return sinks.read_published(spark, path)


@query("job_mortality_files", f"""
SELECT * REPLACE (replace(_ARQUIVO_ORIGEM, '.dbc', '.dbf') AS _ARQUIVO_ORIGEM)
FROM ({_DEATHS_DECODED}) WHERE _ARQUIVO_ORIGEM <> 'DOEXT1996.dbc'
""")
def job_mortality_files(spark, folder):
    """From DBF files to the published table, twice: before the second run one file has men only, which takes its
    rows away, and one is broken, which leaves them."""
    rows = table(spark, folder, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e in DEATHS.items()])
    source, target, manifest = (staging_path(spark, n) for n in ("deaths", "published", "manifest"))
    fields = [(c, "C", 16) for c in DEATHS if c != LINEAGE]
    write_dbf(rows, source, fields, F.replace(F.col(LINEAGE), F.lit(".dbc"), F.lit(".dbf")))
    _expect(mortality.run(spark, source, target, manifest), {"ok"})
    men = rows.filter(f"{LINEAGE} = 'DOEXT1996.dbc' AND CAST(CODMUNRES AS BIGINT) % 2 = 0").withColumn("SEXO", F.lit("1"))
    write_dbf(men, source, fields, F.lit("DOEXT1996.dbf"))
    put_bytes(spark, f"{source}/DOEXT1995.dbf", b"broken")
    _expect(mortality.run(spark, source, target, manifest), {"ok", "failed"})
    return sinks.read_published(spark, target)


def _expect(status: DataFrame, states: set[str]) -> None:
    found = {r.status for r in status.select("status").distinct().collect()}
    if found != states:
        raise ValueError(f"files came out as {found}, not {states}")


def _answers() -> dict[str, str]:
    """Form input: every column cycles through its answers with its own step."""
    out = {}
    for at, column in enumerate(notifications.INPUT_COLUMNS):
        out[column] = f"nullif(substr('1..2.9..1', CAST(({_K} * 7 + {_K} % 13 * {at + 1}) % 9 AS INT) + 1, 1), '.')"
    day = "replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '')"
    return out | {
        "VIOL_MOTIV": f"CASE {_K} % 5 WHEN 0 THEN '01' WHEN 1 THEN '1' WHEN 2 THEN '03' WHEN 3 THEN '88' END",
        "CS_SEXO": f"CASE {_K} % 6 WHEN 0 THEN 'M' WHEN 1 THEN NULL ELSE 'F' END",
        "DT_NOTIFIC": f"CASE {_K} % 4 WHEN 0 THEN {day} WHEN 1 THEN '2000-05-10' WHEN 2 THEN '20000230' ELSE '1999' END",
        "DT_OCOR": f"CASE {_K} % 5 WHEN 0 THEN NULL WHEN 1 THEN '2001-01-01' ELSE {day} END",
        "DT_ENCERRA": f"CASE WHEN {_K} % 3 = 0 THEN {day} END",
        "NU_ANO": "CAST(year(o_orderdate) AS STRING)", "ANO_NASC": f"CASE {_K} % 3 WHEN 0 THEN 'x' ELSE '1980' END",
        "NU_IDADE_N": f"CASE {_K} % 7 WHEN 0 THEN 'A025' ELSE CAST({_K} % 6 AS STRING) || lpad(CAST({_K} % 150 AS STRING), 3, '0') END",
        "LES_AUTOP": f"CASE {_K} % 4 WHEN 0 THEN '1' WHEN 1 THEN NULL WHEN 2 THEN '9' ELSE '2' END",
        "NDUPLIC": f"CASE {_K} % 8 WHEN 0 THEN '2' WHEN 1 THEN '1' END", "NDUPLIC_N": f"CASE {_K} % 9 WHEN 0 THEN '2' WHEN 4 THEN '3' END",
        "CS_ESCOL_N": f"CAST({_K} % 12 AS STRING)", "LOCAL_OCOR": f"CASE {_K} % 3 WHEN 0 THEN '99' ELSE CAST({_K} % 10 AS STRING) END",
        "CICL_VID": f"CASE WHEN {_K} % 2 = 0 THEN CAST({_K} % 6 AS STRING) END", "CICL_VID_AUTOR": "'4'",
    }


FORM = _answers()
# An old layout lacks some columns altogether; they must come back as nulls.
_ABSENT = ["IDENT_GEN", "DEF_OUT", "ENC_SAUDE"]
_FORM_SQL = ", ".join([*(f'{"NULL::VARCHAR" if c in _ABSENT else e} AS "{c}"' for c, e in FORM.items()),
                       "'VIOLBR' || o_orderstatus || '.dbc' AS _ARQUIVO_ORIGEM"])


_B = form_book
# Output lists and the form columns that mark their labels.
_MARKED = {"TIPOS_VIOLENCIA": _B.VIOLENCE_TYPE, "MEIOS_AGRESSAO": _B.MEANS, "TIPOS_VIOLENCIA_SEXUAL": _B.SEXUAL_TYPE,
           "DEFICIENCIAS": _B.DISABILITY, "ENCAMINHAMENTOS": _B.REFERRAL, "VINCULOS_AGRESSOR": _B.RELATIONSHIP}
_BOXES = list(dict.fromkeys([c for book in _MARKED.values() for c in book] + [*_B.INTIMATE_PARTNER, *_B.FAMILY, "VIOL_SEXU"]))


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def _group(name: str, columns: list[str]) -> list[tuple[str, str]]:
    return [(name, c) for c in columns]


# One row per form and ticked or answered box; lists and signs are then joins with what a box stands for.
def _forms(form: str) -> str:
    return f"""
WITH {CALENDAR},
form AS MATERIALIZED (SELECT row_number() OVER () AS r, {form} FROM orders),
chosen AS MATERIALIZED (SELECT * FROM form WHERE CS_SEXO = 'F' AND LES_AUTOP IS DISTINCT FROM '1'
  AND NDUPLIC IS DISTINCT FROM '2' AND NDUPLIC_N IS DISTINCT FROM '2'),
box AS MATERIALIZED (SELECT r, item, mark FROM (SELECT r, {", ".join(_BOXES)} FROM chosen)
  UNPIVOT (mark FOR item IN ({", ".join(_BOXES)}))),
book(list, item, label) AS ({_values((n, c, label) for n, book in _MARKED.items() for c, label in book.items())}),
listed AS (SELECT r, list, string_agg(label, ', ' ORDER BY label) AS labels, count(*) AS n
  FROM (SELECT DISTINCT r, list, label FROM box JOIN book USING (item) WHERE mark = '1') GROUP BY r, list),
sign(sign, item) AS ({_values(_group('partner', _B.INTIMATE_PARTNER) + _group('family', _B.FAMILY)
                              + _group('gender', ['VIOL_SEXU', *_B.INTIMATE_PARTNER]))}),
signed AS (SELECT r, count(*) FILTER (sign = 'partner' AND mark = '1') > 0 AS partner,
  count(*) FILTER (sign = 'family' AND mark = '1') > 0 AS family,
  count(*) FILTER (sign = 'gender' AND mark = '1') > 0 AS gender,
  count(*) FILTER (sign = 'gender' AND mark IN ('1', '2')) > 0 AS told FROM box JOIN sign USING (item) GROUP BY r),
f AS (SELECT chosen.*, n.d AS notified, o.d AS occurred, e.d AS closed FROM chosen
  LEFT JOIN written n ON n.form = DT_NOTIFIC LEFT JOIN written o ON o.form = DT_OCOR LEFT JOIN written e ON e.form = DT_ENCERRA)"""


def _listed(name: str) -> str:
    return f"(SELECT labels FROM listed WHERE listed.r = f.r AND list = '{name}') AS {name}"


_FORMS_DECODED = f"""
SELECT notified AS DT_NOTIFICACAO, TRY_CAST(NU_ANO AS INTEGER) AS ANO_NOTIFICACAO, occurred AS DT_OCORRENCIA,
  HORA_OCOR AS HORA_OCORRENCIA, occurred <= notified AS DATAS_CONSISTENTES, SG_UF_NOT AS UF_NOTIFICACAO,
  ID_MUNICIP AS COD_MUNICIPIO_NOTIFIC, {_label(_B.NOTIFYING_UNIT, 'TP_UNI_EXT', 'UNIDADE_NOTIFICADORA')},
  CASE WHEN regexp_full_match(NU_IDADE_N, '4[0-9]+') AND NU_IDADE_N[2:]::INTEGER <= 120 THEN NU_IDADE_N[2:]::INTEGER
       WHEN regexp_full_match(NU_IDADE_N, '[123][0-9]+') THEN 0 END AS IDADE_ANOS, NU_IDADE_N AS IDADE_CODIGO_ORIGEM,
  coalesce(NDUPLIC, NDUPLIC_N) AS MARCA_DUPLICIDADE_ORIGEM, TRY_CAST(ANO_NASC AS INTEGER) AS ANO_NASCIMENTO,
  {_label(_B.SEX, 'CS_SEXO', 'SEXO')}, {_label(_B.RACE, 'CS_RACA', 'RACA_COR')}, {_label(_B.SCHOOLING, 'CS_ESCOL_N', 'ESCOLARIDADE')},
  {_label(_B.PREGNANT, 'CS_GESTANT', 'GESTANTE')}, {_label(_B.MARITAL_STATUS, 'SIT_CONJUG', 'SITUACAO_CONJUGAL')},
  {_label(_B.ORIENTATION, 'ORIENT_SEX', 'ORIENTACAO_SEXUAL')}, {_label(_B.GENDER_IDENTITY, 'IDENT_GEN', 'IDENTIDADE_GENERO')},
  SG_UF AS UF_RESIDENCIA, ID_MN_RESI AS COD_MUNICIPIO_RESID, {_label(_B.ZONE, 'ZONA', 'ZONA_RESIDENCIA')},
  SG_UF_OCOR AS UF_OCORRENCIA, ID_MN_OCOR AS COD_MUNICIPIO_OCOR, {_label(_B.ZONE, 'ZONA_OCOR', 'ZONA_OCORRENCIA')},
  {_label(_B.PLACE, 'LOCAL_OCOR', 'LOCAL_OCORRENCIA')}, {_label(_B.YES_NO, 'OUT_VEZES', 'VIOLENCIA_DE_REPETICAO')},
  {_label(_B.YES_NO_NA, 'LES_AUTOP', 'LESAO_AUTOPROVOCADA')}, {_label(_B.MOTIVE, 'VIOL_MOTIV', 'VIOLENCIA_MOTIVADA_POR')},
  {_listed('TIPOS_VIOLENCIA')}, {_listed('MEIOS_AGRESSAO')},
  {_listed('TIPOS_VIOLENCIA_SEXUAL')}, {_listed('DEFICIENCIAS')},
  {_listed('ENCAMINHAMENTOS')}, coalesce(partner, false) AS AGRESSOR_PARCEIRO_INTIMO,
  coalesce(family, false) AS AGRESSOR_FAMILIAR,
  CASE WHEN gender OR VIOL_MOTIV IN ('1', '01') THEN 'SIM' WHEN told THEN 'NAO' END AS INDICIO_VIOLENCIA_GENERO,
  {_label(_B.NUMBER_INVOLVED, 'NUM_ENVOLV', 'NUMERO_ENVOLVIDOS')}, {_label(_B.AGGRESSOR_SEX, 'AUTOR_SEXO', 'SEXO_AGRESSOR')},
  {_label(_B.AGGRESSOR_LIFE_STAGE, 'coalesce(CICL_VID, CICL_VID_AUTOR)', 'CICLO_VIDA_AGRESSOR')},
  {_label(_B.YES_NO, 'AUTOR_ALCO', 'AGRESSOR_SUSPEITA_ALCOOL')}, {_label(_B.YES_NO, 'REL_TRAB', 'VIOLENCIA_RELACIONADA_TRABALHO')},
  CIRC_LESAO AS CID_CIRCUNSTANCIA_LESAO, closed AS DT_ENCERRAMENTO, _ARQUIVO_ORIGEM,
  {_listed('VINCULOS_AGRESSOR')}, coalesce((SELECT n FROM listed WHERE listed.r = f.r AND list = 'VINCULOS_AGRESSOR'), 0) AS QTD_VINCULOS_AGRESSOR
FROM f LEFT JOIN signed USING (r)
"""


@query("job_notifications", _forms(_FORM_SQL) + _FORMS_DECODED)
def job_notifications(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        *[f"{e} AS `{c}`" for c, e in FORM.items() if c not in _ABSENT],
        f"'VIOLBR' || o_orderstatus || '.dbc' AS `{LINEAGE}`")
    out = rows.transform(notifications.select_records).transform(notifications.project)
    return out.select(*[lists.join_list(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in out.dtypes])


# In files a column has at most ten characters; those with longer names are absent.
_IN_FILES = [c for c in FORM if len(c) <= 10 and c not in _ABSENT]
_FORM_FILE = "'VIOLBR' || CAST(ascii(o_orderstatus) AS STRING) || '.dbf'"
_FILE_SQL = ", ".join([*(f'{e if c in _IN_FILES else "NULL::VARCHAR"} AS "{c}"' for c, e in FORM.items()),
                       f"{_FORM_FILE} AS _ARQUIVO_ORIGEM"])


@query("job_notifications_files", f"""
SELECT * FROM ({_forms(_FILE_SQL)}{_FORMS_DECODED}) WHERE _ARQUIVO_ORIGEM <> 'VIOLBR80.dbf'
""")
def job_notifications_files(spark, folder):
    """As for deaths: files, two runs, one file with men only and one broken in between."""
    rows = table(spark, folder, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e in FORM.items()], "o_orderstatus", _K)
    source, target, manifest = (staging_path(spark, n) for n in ("forms", "published", "manifest"))
    fields = [(c, "C", 16) for c in _IN_FILES]
    name = F.expr(_FORM_FILE)
    write_dbf(rows, source, fields, name)
    _expect(notifications.run(spark, source, target, manifest), {"ok"})
    men = rows.filter(f"o_orderstatus = 'P' AND {_K} % 2 = 0").withColumn("CS_SEXO", F.lit("M"))
    write_dbf(men, source, fields, name)
    put_bytes(spark, f"{source}/VIOLBR70.dbf", b"broken")
    _expect(notifications.run(spark, source, target, manifest), {"ok", "failed"})
    out = sinks.read_published(spark, target)
    return out.select(*[lists.join_list(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in out.dtypes])


# One document per order; two orders share an id as its two versions.
DOCUMENTS = {
    "id": f"CASE WHEN {_K} % 17 = 0 THEN NULL ELSE 'D' || CAST(CAST(floor({_K} / 2) AS BIGINT) AS STRING) END",
    "tribunal": f"CASE {_K} % 4 WHEN 0 THEN 'TJSP' WHEN 1 THEN 'TJDFT' WHEN 2 THEN 'TJXX' ELSE 'TJBA' END",
    "numeroProcesso": f"lpad(CAST({_K} AS STRING), 9, '0') || CASE WHEN {_K} % 3 = 0 THEN '1980' ELSE '2015' END || "
                      f"CASE WHEN {_K} % 5 = 0 THEN '826000' ELSE '8260001' END",
    "dataAjuizamento": f"CASE {_K} % 6 WHEN 0 THEN '20200228101500' WHEN 1 THEN '2019-02-28T10:15:00.000Z' WHEN 2 THEN '1582848000000' "
                       f"WHEN 3 THEN '1582848000' WHEN 4 THEN '20200230000000' END",
    "grau": f"CASE {_K} % 2 WHEN 0 THEN 'G1' ELSE 'G2' END",
    "nivelSigilo": f"CAST({_K} % 3 AS STRING)",
    "classe": f"""'{{"codigo":' || CASE {_K} % 4 WHEN 0 THEN '1268' WHEN 1 THEN '"12423.0"' WHEN 2 THEN '283' ELSE 'null' END || ',"nome":"Classe ' || CAST({_K} % 4 AS STRING) || '"}}'""",
    "assuntos": f"""CASE {_K} % 9
      WHEN 0 THEN '[{{"codigo":5555,"nome":"Tentado"}},{{"codigo":12091,"nome":"Femin ' || CAST({_K} % 5 AS STRING) || '"}},{{"codigo":12091,"nome":"Femin"}}]'
      WHEN 1 THEN '[{{"codigo":10949,"nome":"Contexto"}},[{{"codigo":"3458","nome":"Sinal"}}],{{"codigo":12091,"nome":"Femin"}}]'
      WHEN 2 THEN '{{"codigo":14943,"nome":"Condicao"}}' WHEN 3 THEN '[]' WHEN 4 THEN 'null'
      WHEN 5 THEN '[{{"codigo":77,"codigoLocal":1}},{{"codigo":null,"nome":"sem"}},{{"codigo":"x"}}]'
      WHEN 6 THEN '[' || repeat('{{"codigo":12194,"nome":"Repetido"}},', 24) || '{{"codigo":14227,"nome":"Descumprimento"}}]'
      WHEN 7 THEN '[{{"codigo":12091,"nome":"Femin"}},{{"codigo":12195,"nome":"Outra"}},{{"codigo":' || CAST({_K} % 40 AS STRING) || ',"nome":"Nome ' || CAST({_K} % 80 AS STRING) || '"}}]' END""",
    "orgaoJulgador": f"""'{{"codigo":' || CAST({_K} AS STRING) || ',"nome":"Vara","codigoMunicipioIBGE":' || CASE {_K} % 4 WHEN 0 THEN '3550308' WHEN 1 THEN '"3550308"' WHEN 2 THEN '"3550308.0"' ELSE 'null' END || '}}'""",
    "formato": """'{"codigo":1,"nome":"Eletronico"}'""",
    "dataHoraUltimaAtualizacao": f"'2024-01-' || lpad(CAST(CAST(floor({_K} / 2) AS BIGINT) % 28 + 1 AS STRING), 2, '0') || CASE {_K} % 2 WHEN 0 THEN 'T10' ELSE 'T11' END || ':15:00.000Z'",
}
_RAW_FIELDS = {"classe", "assuntos", "orgaoJulgador", "formato", "nivelSigilo"}
# A JSON null is read as an absent value.
_DOCUMENT_SQL = ", ".join(f"""nullif({e}, 'null') AS "{c}\"""" for c, e in DOCUMENTS.items())


def _write_documents(spark, folder) -> str:
    """The documents as JSON lines; absent values are left out of the line."""
    def member(name: str, value: str) -> str:
        shown = f"({value})" if name in _RAW_FIELDS else f"""'"' || ({value}) || '"'"""
        return f"""coalesce(',"{name}":' || {shown}, '')"""

    fields = [member(c, e) for c, e in DOCUMENTS.items()]
    line = "'{' || substring(" + " || ".join(fields) + ", 2) || '}' AS value"
    return written(table(spark, folder, "orders").selectExpr(line), "cases", "text")


_N = court_book
_WITH_CASES = f"""
WITH {CALENDAR}, raw AS (SELECT {_DOCUMENT_SQL} FROM orders),
latest AS (SELECT * FROM raw QUALIFY id IS NULL OR row_number() OVER (PARTITION BY id ORDER BY "dataHoraUltimaAtualizacao" DESC) = 1),
parsed AS (SELECT *, list_transform(json_extract(assuntos::JSON, '$..codigo'), lambda c: TRY_CAST(c AS INTEGER)) AS codes,
                  list_transform(json_extract(assuntos::JSON, '$..nome'), lambda n: n ->> '$') AS labels FROM latest),
known AS (SELECT c, min(n) AS n FROM (SELECT unnest(codes) AS c, unnest(labels) AS n FROM parsed WHERE len(codes) = len(labels)) GROUP BY c),
moment AS (SELECT DISTINCT "dataAjuizamento" AS m FROM parsed),
placed AS (SELECT m, d FROM moment JOIN calendar ON compact = m[1:8] WHERE length(m) = 14 AND NOT regexp_matches(m, '[^0-9]')
  UNION ALL SELECT m, d FROM moment JOIN calendar ON starts_with(m, iso || 'T')
  UNION ALL SELECT m, d FROM moment JOIN calendar ON epoch(d) = CASE WHEN NOT regexp_matches(m, '[^0-9]')
    AND length(m) BETWEEN 10 AND 13 THEN m::BIGINT // 86400000 * 86400 END),
dated AS (SELECT parsed.*, d AS day0, CASE WHEN length("numeroProcesso") = 20 AND "numeroProcesso"[10:13]::INTEGER BETWEEN 1990 AND 2026
                      THEN "numeroProcesso"[10:13]::INTEGER END AS year0 FROM parsed LEFT JOIN placed ON m = "dataAjuizamento")"""


def _has(codes: list[int]) -> str:
    return f"list_has_any(codes, {codes})"


@query("job_courts", f"""{_WITH_CASES},
listed AS (
  SELECT id, orgao, string_agg(label, ', ' ORDER BY rank, pos) AS names
  FROM (SELECT u.id, u.orgao, u.pos, coalesce({sql_map(_N.PRIORITY)}[u.code], 99) AS rank, coalesce(k.n, 'ASSUNTO ' || u.code) AS label
        FROM (SELECT id, "orgaoJulgador" AS orgao, code, min(pos) AS pos FROM (
                SELECT id, "orgaoJulgador", unnest(codes) AS code, generate_subscripts(codes, 1) AS pos FROM parsed)
              WHERE code IS NOT NULL GROUP BY ALL) u
        LEFT JOIN known k ON k.c = u.code) GROUP BY ALL),
sorted AS (
  SELECT orgao, string_agg(code::VARCHAR, ', ' ORDER BY code) AS code_text
  FROM (SELECT DISTINCT "orgaoJulgador" AS orgao, unnest(codes) AS code FROM parsed) WHERE code IS NOT NULL GROUP BY orgao)
SELECT d.id AS ID_DATAJUD, "numeroProcesso" AS NUMERO_PROCESSO, tribunal AS TRIBUNAL,
  {sql_map(_N.STATE_OF_COURT)}[tribunal] AS UF, grau AS GRAU,
  CASE WHEN year(day0) BETWEEN 1990 AND 2026 THEN day0 END AS DT_AJUIZAMENTO, "dataAjuizamento" AS DT_AJUIZAMENTO_ORIGEM,
  coalesce(year(DT_AJUIZAMENTO), year0)::BIGINT AS ANO_AJUIZAMENTO,
  CASE WHEN DT_AJUIZAMENTO IS NOT NULL THEN 'DATA' WHEN year0 IS NOT NULL THEN 'NUMERO_PROCESSO' END AS ORIGEM_ANO_AJUIZAMENTO,
  TRY_CAST(classe::JSON ->> '$.codigo' AS BIGINT) AS COD_CLASSE, classe::JSON ->> '$.nome' AS CLASSE,
  len(codes) AS QTD_ASSUNTOS, len(codes) > 20 AS ASSUNTOS_IMPLAUSIVEL, l.names AS ASSUNTOS,
  s.code_text AS COD_ASSUNTOS,
  {_has(_N.FEMICIDE)} AS TEM_FEMINICIDIO, {_has(_N.PROTECTIVE_BREACH)} AS TEM_DESCUMPRIMENTO_PROTETIVA,
  COD_CLASSE IN (1268, 12423) AS EH_MEDIDA_PROTETIVA, {_has(_N.DOMESTIC_CONTEXT)} AS TEM_CONTEXTO_DOMESTICO,
  {_has(_N.TYPIFIED)} AS TEM_VIOLENCIA_TIPIFICADA, {_has(_N.ATTEMPT)} AS TEM_CRIME_TENTADO,
  CASE WHEN TEM_CRIME_TENTADO THEN 'TENTATIVA' WHEN {_has(_N.DEATH_SIGN)} THEN 'CONSUMADO' END AS DESFECHO,
  TRY_CAST("orgaoJulgador"::JSON ->> '$.codigo' AS BIGINT) AS COD_ORGAO_JULGADOR, 'Vara' AS ORGAO_JULGADOR,
  TRY_CAST("orgaoJulgador"::JSON ->> '$.codigoMunicipioIBGE' AS BIGINT) AS COD_MUNICIPIO_IBGE, 'Eletronico' AS FORMATO,
  TRY_CAST("nivelSigilo" AS INTEGER) AS NIVEL_SIGILO, TRY_CAST("dataHoraUltimaAtualizacao" AS TIMESTAMP) AS DT_ULTIMA_ATUALIZACAO
FROM dated d LEFT JOIN listed l ON l.orgao = d."orgaoJulgador" LEFT JOIN sorted s ON s.orgao = d."orgaoJulgador"
""")
def job_courts(spark, folder):
    raw = scans.read_ndjson(spark, _write_documents(spark, folder), court_book.FIELDS)
    return courts.build(raw, 2026, Staging(spark))


_CHOSEN = f"""(SELECT * FROM (SELECT {_DOCUMENT_SQL} FROM orders)
  WHERE list_has_any(list_transform(json_extract(assuntos::JSON, '$..codigo'), lambda c: TRY_CAST(c AS INTEGER)), {_N.SUBSETS['contexto_domestico']})
    AND NOT list_has_any(list_transform(json_extract(assuntos::JSON, '$..codigo'), lambda c: TRY_CAST(c AS INTEGER)), [12195]))"""


@query("job_raw_store", f"""
SELECT tribunal AS key, count(*) AS n_loaded, any_value(total) AS n_declared,
       any_value(total) - count(*) AS diff, false AS complete, 'unit' AS kind
FROM {_CHOSEN}, (SELECT count(*) AS total FROM orders) GROUP BY tribunal
UNION ALL SELECT 'residual_2024', count(*), 0, 0, true, 'residual' FROM {_CHOSEN}
WHERE NOT coalesce("dataAjuizamento" >= '2020' AND "dataAjuizamento" < '2021', false)
UNION ALL SELECT slice, n, 0, 0, true, 'slice' FROM (
  SELECT CASE WHEN n_year >= 400 THEN strftime(d, '%Y%m') ELSE strftime(d, '%Y') END AS slice, count(*) AS n
  FROM (SELECT d, count(*) OVER (PARTITION BY year(d)) AS n_year FROM (
    SELECT CASE "dataAjuizamento" WHEN '2019-02-28T10:15:00.000Z' THEN DATE '2019-02-28'
           WHEN '20200228101500' THEN DATE '2020-02-28' WHEN '1582848000000' THEN DATE '2020-02-28' END AS d FROM {_CHOSEN})
    WHERE d IS NOT NULL) GROUP BY 1)
""")
def job_raw_store(spark, folder):
    raw = scans.read_ndjson(spark, _write_documents(spark, folder), court_book.FIELDS)
    total = table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("n"))
    declared = raw.select("tribunal").distinct().withColumn("n", total.scalar())
    zero = F.lit(0).cast("bigint")
    documents = raw_store.chosen(raw, "contexto_domestico", Staging(spark))
    units = raw_store.completeness(documents, declared).withColumnsRenamed({"tribunal": "key"}).withColumn("kind", F.lit("unit"))
    rest = (raw_store.residual_documents(documents, ["2020"], split=100).groupBy(F.col("slice").alias("key"))
            .agg(F.count(F.lit(1)).alias("n_loaded")).withColumns({"kind": F.lit("residual")}))
    plan = (raw_store.planned_slices(documents, 2026, Staging(spark), split=400)
            .select(F.col("slice").alias("key"), F.col("n").alias("n_loaded"), F.lit("slice").alias("kind")))
    more = rest.unionByName(plan).withColumns({"n_declared": zero, "diff": zero, "complete": F.lit(True)})
    return units.filter("n_loaded > 0").unionByName(more)


def _cell(book: dict, column: str) -> str:
    return f"coalesce({sql_map(book[column])}[{column}], {column}) AS {column}" if column in book else column


def _survey_input(spans: dict, codes: dict) -> dict[str, str]:
    """Answers per column: codes of its book, one unlisted code, and blanks."""
    out = {}
    for at, (column, (start, end)) in enumerate(spans.items()):
        wide = end - start
        out[column] = (f"CASE WHEN (c_custkey + {at}) % 11 = 0 THEN '' ELSE "
                       f"lpad(CAST((c_custkey * {at % 5 + 1} + {at}) % {12 if wide > 1 else 4} AS STRING), {min(wide, 2)}, '0') END")
    return out | {
        "sexo": "CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '2' END",
        "idade": "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE lpad(CAST(c_custkey % 100 AS STRING), 3, '0') END",
        "peso_amostral": "CASE WHEN c_custkey % 10 = 3 THEN '' ELSE lpad(CAST(c_custkey * 12345678 % 9999999999 AS STRING), 14, '0') END",
    }


def _survey_line(spans: dict, fields: dict) -> str:
    parts, at = [], 0
    for column, (start, end) in spans.items():
        if start > at:
            parts.append(f"repeat(' ', {start - at})")
        parts.append(f"rpad({fields[column]}, {end - start}, ' ')")
        at = end
    return " || ".join(parts)


_AGE = "CASE WHEN ltrim(idade, '0') = '' THEN '0' ELSE ltrim(idade, '0') END AS idade"
_WEIGHT = "TRY_CAST(nullif(peso_amostral, '') AS DOUBLE) / 1e8 AS peso_amostral"
_S = survey_book
INPUT_2013, INPUT_2019 = _survey_input(_S.SPANS_2013, _S.BOOKS_2013), _survey_input(_S.SPANS_2019, _S.BOOKS_2019)


def _survey_select(spans: dict, books: dict) -> str:
    return ", ".join(_AGE if c == "idade" else _WEIGHT if c == "peso_amostral" else _cell(books, c) for c in spans)


_DECODED_2013 = (f"(SELECT {_survey_select(_S.SPANS_2013, _S.BOOKS_2013)} FROM (SELECT "
                 + ", ".join(f"{e} AS {c}" for c, e in INPUT_2013.items()) + " FROM customer))")


@query("job_survey_2013", f"""
SELECT 'known' AS output, {", ".join(_S.COMMON)}, {", ".join(_S.KNOWN_2013)},
       coalesce(agressor IN ('{_S.PARTNER_2013[0]}', '{_S.PARTNER_2013[1]}'), false) AS parceiro_intimo
FROM {_DECODED_2013} WHERE sexo = 'Feminino' AND sofreu_violencia = 'Sim'
UNION ALL BY NAME
SELECT 'unknown' AS output, {", ".join(_S.COMMON)}, {", ".join(f"{c} AS {c[2:]}" for c in _S.UNKNOWN_2013)}
FROM {_DECODED_2013} WHERE sexo = 'Feminino' AND d_sofreu_violencia = 'Sim'
""")
def job_survey_2013(spark, folder):
    path = written(table(spark, folder, "customer").selectExpr(f"{_survey_line(_S.SPANS_2013, INPUT_2013)} AS value"), "pns13", "text")
    target = staging_path(spark, "ibge")
    survey_fixed.run_2013(spark, path, target)
    known, unknown = (spark.read.parquet(f"{target}/{n}") for n in (survey_fixed.KNOWN_TABLE_2013, survey_fixed.UNKNOWN_TABLE_2013))
    return known.withColumn("output", F.lit("known")).unionByName(
        unknown.withColumn("output", F.lit("unknown")), allowMissingColumns=True)


@query("job_survey_2019", f"""
SELECT {_survey_select(_S.SPANS_2019, _S.BOOKS_2019)},
       coalesce(raw_psi IN ('01', '02', '03'), false) OR coalesce(raw_fis IN ('01', '02', '03'), false)
         OR coalesce(raw_sex IN ('01', '02', '03'), false) AS parceiro_intimo
FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in INPUT_2019.items())}, psi_agressor AS raw_psi, fis_agressor AS raw_fis,
             sex_agressor AS raw_sex FROM customer)
WHERE sexo = '2' AND '1' IN ({", ".join(_S.ACTS_2019)})
""")
def job_survey_2019(spark, folder):
    path = written(table(spark, folder, "customer").selectExpr(f"{_survey_line(_S.SPANS_2019, INPUT_2019)} AS value"), "pns19", "text")
    target = staging_path(spark, "ibge")
    survey_fixed.run_2019(spark, path, target)
    return spark.read.parquet(f"{target}/{survey_fixed.TABLE_2019}")


@query("job_survey_dictionary", """
SELECT c_custkey::VARCHAR AS numero_do_cliente, coalesce(n_name, c_nationkey::VARCHAR) AS qual_e_a_nacao,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Construção civil' ELSE c_mktsegment END AS segmento,
       c_name AS segmento_c_name, c_acctbal::BIGINT::VARCHAR AS balance
FROM (SELECT *, floor(c_acctbal) AS c_acctbal FROM (SELECT * EXCLUDE c_acctbal, c_acctbal FROM customer))
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) ON n_nationkey = c_nationkey
""".replace("(SELECT *, floor(c_acctbal) AS c_acctbal FROM (SELECT * EXCLUDE c_acctbal, c_acctbal FROM customer))",
            "(SELECT * REPLACE (floor(c_acctbal) AS c_acctbal) FROM customer)"))
def job_survey_dictionary(spark, folder):
    """Answers from customers; the options of one question come from the nations."""
    data = table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS c_custkey", "CAST(c_nationkey AS STRING) AS c_nationkey", "c_mktsegment", "c_name",
        "CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) AS balance")
    csv = written(data, "answers", "csv", sep=";", header=True)
    head = ("`Código da variável` string, `Descrição da variável` string, Regra string, `Código da categoria` string, "
            "`Descrição da categoria` string, row_no bigint")
    fixed = spark.createDataFrame([
        ("BLOCO A", None, None, None, None, 1),
        ("c_custkey", "Número do\ncliente (Ver VD_IDADE)", None, "-", None, 2),
        ("c_mktsegment", "Segmento", None, "BUILDING", "Construção\ncivil", 3),
        ("c_name", "Segmento", None, None, None, 4),
        ("Nota final", None, None, None, None, 5),
        (None, None, None, "BUILDING", "never used", 6),
        ("c_nationkey", "Qual é a nação?", None, None, None, 7)], head)
    options = table(spark, folder, "nation").filter("n_regionkey <> 4").selectExpr(
        "NULL", "NULL", "NULL", "CAST(n_nationkey AS STRING) || ' '", "' ' || n_name", "CAST(8 + n_nationkey AS BIGINT)")
    recoded, _ = survey_dictionary.recode(scans.read_delimited(spark, csv), fixed.unionAll(options))
    return recoded


@query("job_geography", """
SELECT lpad(c_nationkey::VARCHAR, 6, '0') AS cod_municipio, c_name AS regiao, n_name AS nome, n_regionkey::VARCHAR AS macro
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = c_nationkey
""")
def job_geography(spark, folder):
    left = table(spark, folder, "customer").selectExpr("c_nationkey AS cod_municipio", "c_name AS regiao")
    right = table(spark, folder, "nation").filter("n_regionkey <> 2").selectExpr(
        "n_nationkey AS MUNCOD", "n_name AS nome", "n_regionkey AS macro")
    a, b = (written(d, n, "csv", sep=";", header=True) for d, n in ((left, "regions"), (right, "geo")))
    target = staging_path(spark, "geo")
    geography.run(spark, a, b, target)
    return spark.read.parquet(target)
