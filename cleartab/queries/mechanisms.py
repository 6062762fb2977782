"""Stores, boundaries, discovery and concurrent units, each over whole test tables."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.operators import columns, ordered, publish, relational, slices, snapshots
from cleartab.plans import incremental, mortality
from cleartab.queries import query, table
from cleartab.queries.files import _DEATHS_DECODED, DEATHS, _old_and_batch, written
from cleartab.session import Staging, staging_path
from cleartab.sources import text as scans
from cleartab.streaming import documents as stream

# ---- order and slices ----------------------------------------------------------

_FAR = "o_orderkey + CASE WHEN o_orderkey % 5000 = 7 THEN 1000000000000 ELSE 0 END"


@query("forward_fill_outlier", f"""
WITH r AS (SELECT {_FAR} AS pos, o_orderkey % 11 = 3 AS reset, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || o_custkey END AS mark FROM orders)
SELECT pos, last_value(CASE WHEN NOT reset THEN mark END IGNORE NULLS) OVER (PARTITION BY part ORDER BY pos ROWS UNBOUNDED PRECEDING) AS current,
       row_number() OVER (ORDER BY pos) AS n
FROM (SELECT *, sum(reset::INTEGER) OVER (ORDER BY pos) AS part FROM r)
""")
def forward_fill_outlier(spark, folder):
    """All rows are one group, cut into stretches of about a thousand; a few lie 10^12 away from the others."""
    key = F.col("o_orderkey")
    pos = key + F.when(key % 5000 == 7, 10 ** 12).otherwise(0).cast("bigint")
    mark = F.when(key % 3 == 0, F.concat("o_orderstatus", F.col("o_custkey").cast("string")))
    rows = table(spark, folder, "orders").select(
        pos.alias("pos"), (key % 11 == 3).alias("reset"), mark.alias("mark"), F.lit("all").alias("group"))
    filled = ordered.forward_fill(rows, ["group"], "pos", F.when(~F.col("reset"), F.col("mark")), F.col("reset"), "current", rows=1000)
    return ordered.occurrence_number(filled, ["group"], "pos", "n", rows=1000).select("pos", "current", "n")


@query("slices_many", """
WITH s AS (SELECT (1500 + i // 12)::VARCHAR || lpad((i % 12 + 1)::VARCHAR, 2, '0') AS slice,
                  (1500 + (i + 1) // 12)::VARCHAR || lpad(((i + 1) % 12 + 1)::VARCHAR, 2, '0') AS next FROM range(10000) r(i)),
d AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d%H%M%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT slice, count(day) AS n FROM s LEFT JOIN d ON day >= slice AND day < next GROUP BY slice
UNION ALL SELECT 'residual', count(*) FROM d WHERE day IS NULL OR day < '150001' OR day >= '233305'
""")
def slices_many(spark, folder):
    """Ten thousand monthly slices and what lies outside them, both by one array of bounds."""
    prefixes = [f"{1500 + i // 12}{i % 12 + 1:02d}" for i in range(10_000)]
    key = F.col("o_orderkey") % 3
    days = table(spark, folder, "orders").select(
        F.when(key == 0, F.date_format("o_orderdate", "yyyyMMddHHmmss")).when(key == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    rest = days.filter(slices.residual(F.col("day"), prefixes)).agg(F.count(F.lit(1)).alias("n"))
    return slices.slice_counts(days, "day", prefixes).unionAll(rest.select(F.lit("residual").alias("slice"), "n"))


# ---- stores ----------------------------------------------------------------------

_REPLACED = """
WITH old AS (SELECT o_orderkey, o_totalprice, 'ORD' || year(o_orderdate) || '.dbc' AS _ARQUIVO_ORIGEM FROM orders)
SELECT 'new' AS seen, *, NULL AS mark FROM old WHERE _ARQUIVO_ORIGEM NOT IN ('ORD1996.dbc', 'ORD1998.dbc', 'ORD2000.dbc')
UNION ALL SELECT 'new', o_orderkey, o_totalprice * 2, lower(_ARQUIVO_ORIGEM), 'R' FROM old
WHERE _ARQUIVO_ORIGEM IN ('ORD1996.dbc', 'ORD2000.dbc') AND o_totalprice > 1000
UNION ALL SELECT 'old', *, NULL FROM old
"""


@query("publish_snapshot", _REPLACED)
def publish_snapshot(spark, folder):
    """Three of seven source files change in one step, one of them to no rows, two to another spelling; the version
    before is still whole. A second writer that started from it fails."""
    old, new = _old_and_batch(spark, folder)
    path = staging_path(spark, "snapshots")
    snapshots.replace_sources(old, path, [f"ORD{y}.dbc" for y in range(1990, 2010)])
    batch = new.withColumn(LINEAGE, F.lower(LINEAGE))
    for _ in range(2):
        snapshots.replace_sources(batch, path, ["ord1996.dbc", "ord1998.dbc", "ord2000.dbc"])
    try:
        snapshots.commit(spark, path, 1, snapshots.state(spark, path, 0)[1])
        raise ValueError("a taken version was put again")
    except snapshots.Conflict:
        pass
    before = snapshots.read(spark, path, 0).select("o_orderkey", "o_totalprice", LINEAGE, F.lit(None).cast("string").alias("mark"))
    return (snapshots.read(spark, path).select("o_orderkey", "o_totalprice", LINEAGE, "mark", F.lit("new").alias("seen"))
            .unionByName(before.withColumn("seen", F.lit("old"))))


@query("empty_table", """
SELECT 'n' || i AS column_name, 0::BIGINT AS n_rows, (SELECT count(*) FROM orders WHERE o_totalprice < 0) AS n_written
FROM (SELECT unnest(['_o_orderkey bigint', '_o_totalprice double', '_o_orderpriority string']) AS i)
""")
def empty_table(spark, folder):
    """A selection that no row meets, published and read back: no rows, the same columns."""
    none = table(spark, folder, "orders").filter("o_totalprice < 0").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = staging_path(spark, "empty")
    n = publish.publish(none, path)
    back = spark.read.parquet(path)
    names = spark.createDataFrame([(f"n_{c} {t}", n) for c, t in back.dtypes], "column_name string, n_written bigint")
    return names.join(back.agg(F.count("*").alias("n_rows")), F.col("n_rows") >= 0).select("column_name", "n_rows", "n_written")


@query("stream_compacted", """
WITH v AS (SELECT 'u' || user_id % 97 AS id, event_id % 12 AS batch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, event_id::VARCHAR AS event FROM events),
b AS (SELECT batch, count(DISTINCT id) AS n FROM v GROUP BY batch)
SELECT id, seen, event FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY seen DESC, event DESC) = 1
UNION ALL SELECT 'live rows, at most', NULL, (3 * count(DISTINCT id) * 3)::VARCHAR FROM v
""")
def stream_compacted(spark, folder):
    """Twelve batches at a fanout of three: levels are merged in between, and what stays live is bounded by the
    distinct documents per level, not by the batches."""
    fields, order, fanout = ["id", "seen", "event"], [F.col("seen").desc(), F.col("event").desc()], 3
    rows = table(spark, folder, "events").select(
        F.concat(F.lit("u"), (F.col("user_id") % 97).cast("string")).alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"), F.col("event_id").cast("string").alias("event"),
        (F.col("event_id") % 12).alias("batch"))
    arrivals, store, progress = (staging_path(spark, n) for n in ("arrivals", "store", "progress"))
    written_ = rows.repartition(12, "batch").select("id", "seen", "event", "batch")
    written_.write.partitionBy("batch").json(arrivals)
    stream.ingest(spark, f"{arrivals}/batch=*", store, progress, fields, ["id"], order, fanout, files_per_batch=1)
    runs = stream.live_rows(spark, store)
    documents = rows.select("id").distinct().count()
    bound = 3 * documents * 3
    if sum(map(sum, runs.values())) > bound or any(len(r) >= fanout for r in runs.values()):
        raise ValueError(f"live runs {runs} hold more than {bound} rows")
    note = spark.createDataFrame([("live rows, at most", None, str(bound))], "id string, seen string, event string")
    return stream.current(spark, store, fields, ["id"], order).unionByName(note)


# ---- scans -------------------------------------------------------------------------

@query("ndjson_discovered", """
SELECT event_id AS id, event_type AS kind, CASE WHEN event_type = 'view' THEN value END AS price,
       CASE event_type WHEN 'click' THEN user_id::VARCHAR WHEN 'view' THEN 'u' || user_id END AS who,
       CASE WHEN event_type = 'error' THEN '{"code":' || (event_id % 5) || '}' END AS detail, event_type = 'click' AS clicked
FROM events
""")
def ndjson_discovered(spark, folder):
    """Files of several layouts without a list of fields: columns united by name, a number here and a text there as
    text, nested values as raw JSON, and types where all values agree."""
    rows = table(spark, folder, "events")
    path = staging_path(spark, "layouts")
    for kind, shape in (("view", ["value AS price", "concat('u', user_id) AS who"]), ("click", ["user_id AS who"]),
                        ("error", ["named_struct('code', event_id % 5) AS detail"]), (None, ["1 AS unused"])):
        part = rows.filter(F.col("event_type") == kind if kind else ~F.col("event_type").isin("view", "click", "error"))
        publish.append_ndjson(part.selectExpr("event_id AS id", "event_type AS kind", "event_type = 'click' AS clicked", *shape), path)
    found = scans.read_ndjson(spark, path, typed=True)
    return found.drop("unused")


# ---- units, counts, reports ----------------------------------------------------------

@query("status_units", """
SELECT o_orderpriority AS unit, CASE o_orderpriority WHEN '2-HIGH' THEN 'failed' WHEN '5-LOW' THEN 'cancelled' ELSE 'processed' END AS status,
       CASE WHEN o_orderpriority NOT IN ('2-HIGH', '5-LOW') THEN count(*) END AS n_rows,
       o_orderpriority IN ('2-HIGH', '5-LOW') AS has_error
FROM orders GROUP BY o_orderpriority
""")
def status_units(spark, folder):
    """One job per priority, side by side. One fails; one is slow, is given up as soon as the others are done, and is
    recorded as cancelled."""
    orders, root = table(spark, folder, "orders"), staging_path(spark, "priorities")
    units = [r[0] for r in orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()]
    done = set()

    def work(unit):
        rows = orders.filter(F.col("o_orderpriority") == unit)
        if unit == "2-HIGH":
            rows = rows.filter(F.raise_error(F.lit("broken input")).isNull())
        while unit == "5-LOW":  # jobs without end, until they are cancelled
            rows.filter("o_totalprice < 0").count()
        try:
            return publish.publish(rows, f"{root}/{unit}")
        finally:
            done.add(unit)

    limit = time.monotonic() + 300
    wanted = lambda unit: unit != "5-LOW" or (len(done) < len(units) - 1 and time.monotonic() < limit)
    found = publish.isolated(spark, units, work, parallel=len(units), wanted=wanted)
    return found.select("unit", "status", "n_rows", F.col("error").isNotNull().alias("has_error"))


_CATALOG = """SELECT 'o' || lpad(o_orderkey::VARCHAR, 12, '0') || '.parquet' AS arquivo, CASE WHEN o_orderkey % 5 = 0 THEN 'a "b", c' ELSE o_orderstatus END AS diretorio,
  o_custkey::VARCHAR AS num_registros FROM orders"""


@query("catalog_lines", f"""
SELECT line, arquivo, diretorio, num_registros FROM (SELECT *, row_number() OVER (ORDER BY arquivo) AS line FROM ({_CATALOG}))
UNION ALL SELECT 0, 'headers', 'parts > 1: true', '1'
""")
def catalog_lines(spark, folder):
    """A catalog of one line per order over several part files: numbered lines in order, one header in all."""
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("o"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".parquet")).alias("arquivo"),
        F.when(F.col("o_orderkey") % 5 == 0, 'a "b", c').otherwise(F.col("o_orderstatus")).alias("diretorio"),
        F.lit("x").alias("fontes_relacionadas"), F.col("o_custkey").alias("num_registros"), F.lit(1).cast("bigint").alias("num_colunas"),
        F.lit(1).cast("bigint").alias("tamanho_bytes"), F.lit("now").alias("ultima_atualizacao"))
    path = staging_path(spark, "catalog_lines")
    publish.write_catalog(rows, path, rows_per_file=500)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    head = lines.filter(F.col("value").contains("arquivo,diretorio"))
    parts = lines.select("file").distinct().count()
    note = spark.createDataFrame([(0, "headers", f"parts > 1: {str(parts > 1).lower()}", str(head.count()))],
                                 "line bigint, arquivo string, diretorio string, num_registros string")
    with Staging(spark) as area:
        numbered = ordered.numbered(publish.read_catalog(spark, path), [F.col("arquivo")], "line", area)
        kept = Staging(spark).table(numbered.select("line", "arquivo", "diretorio", "num_registros"), "lines")
    return kept.unionByName(note)


@query("distinct_by_file", """
WITH o AS (SELECT year(o_orderdate) AS file, CASE WHEN o_custkey % 3 = 0 THEN '000' || o_custkey || '00012345678901' WHEN o_custkey % 3 = 1 THEN o_custkey::VARCHAR
                  ELSE 'case ' || o_custkey END AS entity FROM orders),
later AS (SELECT * FROM o WHERE file <> 1997 UNION ALL SELECT 1997, entity || '7' FROM o WHERE file = 1997 AND entity LIKE '0%')
SELECT file::VARCHAR AS file, count(DISTINCT entity) AS n_entities FROM later GROUP BY file
UNION ALL SELECT 'all', count(DISTINCT entity) FROM later UNION ALL SELECT 'before', count(DISTINCT entity) FROM o
""")
def distinct_by_file(spark, folder):
    """Distinct cases of each file and of all, from bitmaps; one file is replaced and only its own rows are read again."""
    key = F.col("o_custkey")
    entity = (F.when(key % 3 == 0, F.concat(F.lit("000"), key.cast("string"), F.lit("00012345678901")))
              .when(key % 3 == 1, key.cast("string")).otherwise(F.concat(F.lit("case "), key.cast("string"))))
    rows = table(spark, folder, "orders").select(F.year("o_orderdate").cast("string").alias(LINEAGE), entity.alias("entity"))
    path = staging_path(spark, "cases")
    snapshots.replace_sources(relational.entity_bitmaps(rows, LINEAGE, "entity"), path, [str(y) for y in range(1990, 2010)])
    new = rows.filter((F.col(LINEAGE) == "1997") & F.col("entity").startswith("0")).withColumn("entity", F.concat("entity", F.lit("7")))
    snapshots.replace_sources(relational.entity_bitmaps(new, LINEAGE, "entity"), path, ["1997"])
    now = snapshots.read(spark, path)
    total = relational.entities_in(now).select(F.lit("all").alias("file"), "n_entities")
    before = relational.entities_in(snapshots.read(spark, path, 0)).select(F.lit("before").alias("file"), "n_entities")
    return relational.entities_in(now, [LINEAGE]).withColumnRenamed(LINEAGE, "file").unionByName(total).unionByName(before)


_HOOK = """
SELECT DTNASC AS DT_NASCIMENTO, DTOBITO AS DT_OBITO, CAUSABAS AS CAUSA_BASICA, '{' || CODMUNRES || '}' AS COD_MUNICIPIO_RESID, `_ARQUIVO_ORIGEM`
FROM __ORIGEM__ WHERE SEXO = :sex"""


@query("job_mortality_sql", f"""
SELECT DT_NASCIMENTO, DT_OBITO, CAUSA_BASICA, '{{' || COD_MUNICIPIO_RESID || '}}' AS COD_MUNICIPIO_RESID, _ARQUIVO_ORIGEM FROM ({_DEATHS_DECODED})
""")
def job_mortality_sql(spark, folder):
    """The deaths job with its projection as SQL text and the snapshot sink, against the job in functions."""
    rows = table(spark, folder, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e in DEATHS.items()])
    raw = incremental.from_parquet(spark, [written(rows, "deaths")])
    path, manifest = staging_path(spark, "mortality"), staging_path(spark, "manifest")
    names = rows.select(F.col(LINEAGE).alias("name")).distinct().select("name", F.lit(1).cast("bigint").alias("size_bytes"), F.lit("ok").alias("status"))
    incremental.run(raw, names, mortality.select_records, incremental.sql_hook(_HOOK, sex="2"), path, manifest, snapshots.replace_sources)
    return snapshots.read(spark, path)


@query("unlisted_values", """
SELECT 'p_brand' AS column_name, count(*) AS n_rows, count(p_brand) AS n_filled, sum(length(p_name))::BIGINT AS kept FROM part
UNION ALL SELECT 'p_type', count(*), count(CASE WHEN p_size > 10 THEN p_type END), sum(length(p_name)) FROM part
""")
def unlisted_values(spark, folder):
    """Columns that no dictionary names leave the table, and the report says how much they held."""
    part = table(spark, folder, "part").selectExpr("p_partkey", "p_name", "p_brand", "CASE WHEN p_size > 10 THEN p_type END AS p_type")
    kept, report = columns.keep_listed(part, ["p_partkey", "p_name", "p_other"])
    total = kept.agg(F.sum(F.length("p_name")).alias("kept")).scalar()
    return report.withColumn("kept", total)
