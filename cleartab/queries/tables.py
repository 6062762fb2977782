"""Unions, publishing rules, slices, listings and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.functions import text
from cleartab.operators import columns, ingest, ordered, publish, relational, slices
from cleartab.queries import query, table
from cleartab.session import Staging
from cleartab.sources.listing import table_counts

def _year():
    return F.year("o_orderdate")


@query("ensure_columns_union", """
SELECT o_custkey AS id, o_totalprice AS price, NULL::VARCHAR AS name, NULL::VARCHAR AS segment FROM orders
UNION ALL BY NAME SELECT c_custkey AS id, c_name AS name FROM customer
""")
def ensure_columns_union(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("price"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return relational.union_by_name(columns.ensure_columns(orders, ["id", "name", "segment"]), customers)


def _with_source(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.concat(F.lit("ORD"), _year().cast("string"), F.lit(".dbc")).alias(LINEAGE))


_REPLACED = """
WITH old AS (SELECT o_orderkey, o_totalprice, 'ORD' || year(o_orderdate) || '.dbc' AS _ARQUIVO_ORIGEM FROM orders),
     new AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, _ARQUIVO_ORIGEM, 'R' AS mark
             FROM old WHERE _ARQUIVO_ORIGEM IN ('ORD1996.dbc', 'ORD2000.dbc') AND o_totalprice > 1000)
SELECT * FROM old WHERE _ARQUIVO_ORIGEM NOT IN ('ORD1996.dbc', 'ORD2000.dbc', 'ORD1998.dbc')
UNION ALL BY NAME SELECT * FROM new
"""


@query("replace_by_source", _REPLACED)
def replace_by_source(spark, folder):
    """File 1998 is in the batch but yields no rows, so its old ones go; names
    differ in case."""
    old = _with_source(spark, folder)
    new = (old.filter(F.col(LINEAGE).isin("ORD1996.dbc", "ORD2000.dbc") & (F.col("o_totalprice") > 1000))
           .withColumns({"o_totalprice": F.col("o_totalprice") * 2, "mark": F.lit("R")}))
    return publish.replace_by_source(old, new, ["ord1996.DBC", "ORD2000.dbc", "ORD1998.dbc"])


@query("in_not_in", """
SELECT o_orderkey, status, status IN ('F', 'O') AS listed FROM (
  SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, o_orderpriority FROM orders)
WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT') AND (status = 'F' OR status IS NULL)
""")
def in_not_in(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"), "o_orderpriority")
    dropped = spark.createDataFrame([("5-LOW",), ("1-URGENT",)], "code string")
    kept = relational.not_in_codes(rows, "o_orderpriority", dropped)
    kept = kept.filter((F.col("status") == "F") | F.col("status").isNull())
    return kept.select("o_orderkey", "status", F.col("status").isin("F", "O").alias("listed"))


@query("set_ops", """
SELECT 'all' AS kind, k, count(*) AS n FROM (
  SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey FROM supplier) GROUP BY k
UNION ALL SELECT 'only_customer', k, 1 FROM (
  SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'both', k, 1 FROM (
  SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
""")
def set_ops(spark, folder):
    customers, suppliers = table(spark, folder, "customer"), table(spark, folder, "supplier")
    left = customers.select(F.col("c_nationkey").alias("k"))
    right = suppliers.select(F.col("s_nationkey").alias("k"))
    rich = suppliers.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    one = F.lit(1).cast("bigint").alias("n")
    all_ = (relational.union_by_name(customers.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")), right)
            .groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("kind"), "k", "n"))
    only = relational.key_difference(left, rich).select(F.lit("only_customer").alias("kind"), "k", one)
    both = relational.key_intersection(left, rich).select(F.lit("both").alias("kind"), "k", one)
    return all_.unionAll(only).unionAll(both)


@query("zero_pad_join", """
SELECT c_custkey, key, n_name FROM (
  SELECT c_custkey, CASE WHEN length(k) < 6 THEN lpad(k, 6, '0') ELSE k END AS key
  FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN '1234567' ELSE c_nationkey::VARCHAR END AS k FROM customer))
LEFT JOIN (SELECT lpad(n_nationkey::VARCHAR, 6, '0') AS MUNCOD, n_name FROM nation WHERE n_regionkey <> 2) ON MUNCOD = key
""")
def zero_pad_join(spark, folder):
    raw = F.when(F.col("c_custkey") % 10 == 7, "1234567").otherwise(F.col("c_nationkey").cast("string"))
    left = table(spark, folder, "customer").select("c_custkey", text.zero_pad(raw, 6).alias("key"))
    right = table(spark, folder, "nation").filter("n_regionkey <> 2").select(
        text.zero_pad(F.col("n_nationkey").cast("string"), 6).alias("MUNCOD"), "n_name")
    return relational.left_join_on(left, right, "key", "MUNCOD")


# Text days of the orders; one priority writes them with dashes, so that those
# fall outside all text ranges.
_DAY_SQL = """(SELECT o_orderkey, o_orderdate, o_totalprice, CASE o_orderpriority
  WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '1-URGENT' THEN NULL
  ELSE strftime(o_orderdate, '%Y%m%d') END AS day FROM orders)"""
_COVERED = ["1995", "1996", "1997", "199806", "199812"]
_IN_SQL = ("(day >= '1995' AND day < '1998') OR (day >= '199806' AND day < '199807') "
           "OR (day >= '199812' AND day < '199901')")


def _days(spark, folder):
    kind = F.col("o_orderpriority")
    day = F.when(kind == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        kind != "1-URGENT", F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", day.alias("day"))


@query("range_buckets", f"""
SELECT slice, count(day) AS n FROM (VALUES ('1995'), ('1996'), ('1997'), ('199806'), ('199812')) AS s(slice)
LEFT JOIN {_DAY_SQL} ON day >= slice
  AND day < CASE slice WHEN '199812' THEN '199901' ELSE (slice::INTEGER + 1)::VARCHAR END GROUP BY slice
""")
def range_buckets(spark, folder):
    return slices.slice_counts(_days(spark, folder), "day", _COVERED)


@query("residual_rows", f"SELECT o_orderkey, day FROM {_DAY_SQL} WHERE NOT coalesce({_IN_SQL}, false)")
def residual_rows(spark, folder):
    return _days(spark, folder).filter(slices.residual(F.col("day"), _COVERED)).select("o_orderkey", "day")


@query("residual_split", f"""
SELECT o_orderkey, CASE WHEN count(*) OVER () >= 500 AND year(second) >= 1999
                        THEN 'residual_' || year(second) ELSE 'residual' END AS slice
FROM (SELECT o_orderkey, CASE WHEN o_totalprice > 50000 THEN o_orderdate END AS second
      FROM {_DAY_SQL} WHERE NOT coalesce({_IN_SQL}, false))
""")
def residual_split(spark, folder):
    rows = _days(spark, folder).filter(slices.residual(F.col("day"), _COVERED))
    second = F.when(F.col("o_totalprice") > 50000, F.col("o_orderdate"))
    return slices.residual_slices(rows, second, split=500, first_year=1999).select("o_orderkey", "slice")


_PLAN = """SELECT CASE WHEN n_year >= {split} THEN strftime(o_orderdate, '%Y%m') ELSE strftime(o_orderdate, '%Y') END AS slice,
       count(*) AS n FROM (SELECT o_orderdate, count(*) OVER (PARTITION BY year(o_orderdate)) AS n_year FROM orders) GROUP BY 1"""


def _plan(spark, folder, split):
    return slices.slice_plan(table(spark, folder, "orders"), _year(), F.month("o_orderdate"), Staging(spark), split)


@query("slice_plan", _PLAN.format(split=2250))
def slice_plan(spark, folder):
    return _plan(spark, folder, 2250)


@query("slice_plan_untrusted", """
SELECT 'years' AS kind, y::VARCHAR AS slice, count(o_orderkey) AS n
FROM range(1990, 2001) AS years(y) LEFT JOIN orders ON year(o_orderdate) = y AND o_orderkey % 5 < 2 GROUP BY y
UNION ALL
SELECT 'months', slice, n FROM (
  SELECT strftime(o_orderdate, '%Y') AS slice, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1995 GROUP BY 1
  UNION ALL SELECT '1995' || lpad(m::VARCHAR, 2, '0'), count(o_orderkey) FROM range(1, 13) AS months(m)
  LEFT JOIN orders ON year(o_orderdate) = 1995 AND month(o_orderdate) = m AND m = 3 GROUP BY m)
""")
def slice_plan_untrusted(spark, folder):
    """Counts that cannot be trusted: most rows without a year, then a year with most rows without a month.
    All years of the range, and all months of that year, are kept."""
    orders, area = table(spark, folder, "orders"), Staging(spark)
    vague = F.when(F.col("o_orderkey") % 5 < 2, _year())
    years = slices.slice_plan(orders, vague, F.month("o_orderdate"), area, 1, years=(1990, 2000))
    first = orders.filter("year(o_orderdate) = 1995").count()
    others = orders.filter("year(o_orderdate) <> 1995").groupBy(_year()).count().agg(F.max("count")).first()[0]
    month = F.when((_year() != 1995) | (F.month("o_orderdate") == 3), F.month("o_orderdate"))
    # Only 1995 reaches the split: its rows are tripled.
    tripled = orders.withColumn("_times", F.explode(F.sequence(F.lit(1), F.when(_year() == 1995, 3).otherwise(1))))
    months = slices.slice_plan(tripled, _year(), month, area, max(others, first) + 1)
    months = months.withColumn("n", F.when(F.col("slice").startswith("1995"), F.col("n") / 3).otherwise(F.col("n")).cast("bigint"))
    return years.select(F.lit("years").alias("kind"), "slice", "n").unionByName(
        months.select(F.lit("months").alias("kind"), "slice", "n"))


@query("slice_drift", f"SELECT slice FROM ({_PLAN.format(split=2300)}) EXCEPT SELECT slice FROM ({_PLAN.format(split=2250)})")
def slice_drift(spark, folder):
    return slices.plan_drift(_plan(spark, folder, 2300), _plan(spark, folder, 2250))


@query("reconcile_counts", """
WITH loaded AS (SELECT strftime(o_orderdate, '%Y') AS unit, count(*) AS n_loaded FROM orders
                WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 1) GROUP BY 1),
     declared AS (SELECT unit, max(n)::BIGINT AS n_declared FROM (
                    SELECT strftime(o_orderdate, '%Y') AS unit, o_orderstatus, count(*) OVER (PARTITION BY year(o_orderdate)) AS n
                    FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01') GROUP BY 1)
SELECT unit, coalesce(n_loaded, 0) AS n_loaded, coalesce(n_declared, 0) AS n_declared,
       coalesce(n_declared, 0) - coalesce(n_loaded, 0) AS diff,
       n_declared IS NOT NULL AND coalesce(n_loaded, 0) = n_declared AS complete
FROM loaded FULL JOIN declared USING (unit)
""")
def reconcile_counts(spark, folder):
    """Loaded: orders with lines. Declared: two observations per year, of which the
    higher one counts."""
    orders = table(spark, folder, "orders").withColumn("unit", F.date_format("o_orderdate", "yyyy"))
    lines = table(spark, folder, "lineitem").filter("l_quantity > 1").select("l_orderkey")
    loaded = relational.in_codes(orders, "o_orderkey", lines, "l_orderkey")
    counted = (orders.filter("o_orderdate < timestamp_ntz'2001-01-01 00:00:00'")
               .groupBy("unit").agg(F.count(F.lit(1)).alias("n")))
    observed = counted.select("unit", F.explode(F.array(F.col("n"), F.floor(F.col("n") / 2))).alias("n"))
    return slices.reconcile(loaded, observed, "unit")


@query("recent_periods", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period FROM orders
QUALIFY dense_rank() OVER (ORDER BY period DESC) <= 3
""")
def recent_periods(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("period"))
    return ordered.in_latest_periods(rows, "period", 3).select("o_orderkey", "period")


# One file per order: its name in either case, its price as size; some orders
# have a second spelling, and control files appear among them.
_FILES_SQL = """(SELECT CASE WHEN o_orderstatus = 'F' THEN 'ORD' ELSE 'ord' END || o_orderkey || '.dbc' AS name,
       floor(o_totalprice)::BIGINT AS size_bytes FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL SELECT 'Ord' || o_orderkey || '.DBC', floor(o_totalprice)::BIGINT + 1 FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT '_checkpoint_' || o_orderkey || '.json', 1 FROM orders WHERE o_orderpriority = '1-URGENT')"""
_MANIFEST_SQL = """(SELECT 'ORD' || o_orderkey || '.DBC' AS source_file,
       floor(o_totalprice)::BIGINT + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS size_bytes
  FROM orders WHERE o_orderpriority <> '3-MEDIUM')"""


def _files(spark, folder):
    orders = table(spark, folder, "orders")
    key, size = F.col("o_orderkey").cast("string"), F.floor("o_totalprice").cast("bigint")
    prefix = F.when(F.col("o_orderstatus") == "F", "ORD").otherwise("ord")
    first = orders.filter("o_orderpriority <> '5-LOW'").select(
        F.concat(prefix, key, F.lit(".dbc")).alias("name"), size.alias("size_bytes"))
    second = orders.filter("o_orderpriority = '2-HIGH'").select(
        F.concat(F.lit("Ord"), key, F.lit(".DBC")).alias("name"), (size + 1).alias("size_bytes"))
    control = orders.filter("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("_checkpoint_"), key, F.lit(".json")).alias("name"), F.lit(1).cast("bigint").alias("size_bytes"))
    return first.unionAll(second).unionAll(control)


def _manifest(spark, folder):
    changed = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    return table(spark, folder, "orders").filter("o_orderpriority <> '3-MEDIUM'").select(
        F.concat(F.lit("ORD"), F.col("o_orderkey").cast("string"), F.lit(".DBC")).alias("source_file"),
        (F.floor("o_totalprice").cast("bigint") + changed).alias("size_bytes"))


_UNIQUE_SQL = f"""(SELECT min(name) AS name, arg_min(size_bytes, name) AS size_bytes FROM {_FILES_SQL}
  WHERE name NOT LIKE '\\_checkpoint\\_%' ESCAPE '\\' GROUP BY upper(name))"""


@query("manifest_skip", f"""
SELECT name, f.size_bytes FROM {_UNIQUE_SQL} f LEFT JOIN {_MANIFEST_SQL} m
  ON upper(name) = source_file AND f.size_bytes = m.size_bytes WHERE source_file IS NULL
""")
def manifest_skip(spark, folder):
    files = ingest.unique_names(ingest.data_files(_files(spark, folder)))
    return ingest.not_in_manifest(files, _manifest(spark, folder))


@query("files_to_check", f"""
SELECT name, size_bytes, period FROM (
  SELECT *, regexp_extract(name, '([0-9]+)[.][A-Za-z0-9_]+$', 1) AS digits,
         CASE WHEN length(digits) <> 2 THEN digits WHEN digits >= '90' THEN '19' || digits ELSE '20' || digits END AS period
  FROM {_UNIQUE_SQL})
WHERE upper(name) NOT IN (SELECT source_file FROM {_MANIFEST_SQL})
   OR period IN (SELECT DISTINCT CASE WHEN length(d) <> 2 THEN d WHEN d >= '90' THEN '19' || d ELSE '20' || d END AS p
                 FROM (SELECT regexp_extract(name, '([0-9]+)[.]', 1) AS d FROM {_UNIQUE_SQL}) ORDER BY p DESC LIMIT 2)
""")
def files_to_check(spark, folder):
    files = ingest.unique_names(ingest.data_files(_files(spark, folder)))
    return ingest.to_check(files, _manifest(spark, folder), 2)


@query("groups_changed", f"""
SELECT status, NOT bool_and(m.source_file IS NOT NULL) AS changed FROM (
  SELECT o_orderstatus || '-' || o_orderkey // 3 AS status, 'ORD' || o_orderkey || '.DBC' AS f, floor(o_totalprice)::BIGINT AS s FROM orders) p
LEFT JOIN {_MANIFEST_SQL} m ON f = source_file AND s = size_bytes GROUP BY status
""")
def groups_changed(spark, folder):
    parts = table(spark, folder, "orders").select(
        F.concat_ws("-", "o_orderstatus", F.floor(F.col("o_orderkey") / 3).cast("string")).alias("status"),
        F.concat(F.lit("ord"), F.col("o_orderkey").cast("string"), F.lit(".dbc")).alias("name"),
        F.floor("o_totalprice").cast("bigint").alias("size_bytes"))
    return ingest.groups_to_process(parts, _manifest(spark, folder), "status")


@query("listing_diff", f"""
SELECT coalesce(a.name, b.name) AS name, a.size_bytes AS size_source, b.size_bytes AS size_copy,
       CASE WHEN b.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'orphan'
            WHEN a.size_bytes = b.size_bytes THEN 'unchanged' ELSE 'changed' END AS status
FROM (SELECT upper(name) AS name, size_bytes FROM {_UNIQUE_SQL}) a
FULL JOIN (SELECT source_file AS name, size_bytes FROM {_MANIFEST_SQL}) b ON a.name = b.name
""")
def listing_diff(spark, folder):
    files = ingest.unique_names(ingest.data_files(_files(spark, folder)))
    copy = _manifest(spark, folder).withColumnRenamed("source_file", "name")
    return ingest.listing_diff(files.withColumn("name", F.upper("name")), copy)


@query("pair_by_year", """
WITH data AS (SELECT strftime(o_orderdate, '%Y') AS year, max('pnvd_' || lower(o_orderstatus) || strftime(o_orderdate, '%Y') || '.csv') AS data_file
              FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1),
     dict AS (SELECT strftime(o_orderdate, '%Y') AS year, max('pnvd_dict_' || strftime(o_orderdate, '%Y') || '.xlsx') AS dict_file
              FROM orders WHERE year(o_orderdate) < 2000 GROUP BY 1)
SELECT year, data_file, dict_file, CASE WHEN dict_file IS NULL THEN 'data_only' WHEN data_file IS NULL THEN 'dictionary_only'
         ELSE 'paired' END AS status FROM data FULL JOIN dict USING (year)
""")
def pair_by_year(spark, folder):
    orders = table(spark, folder, "orders")
    year = F.date_format("o_orderdate", "yyyy")
    data = orders.filter(_year() != 1997).select(
        F.concat(F.lit("pnvd_"), F.lower("o_orderstatus"), year, F.lit(".csv")).alias("name"))
    books = orders.filter(_year() < 2000).select(F.concat(F.lit("pnvd_dict_"), year, F.lit(".xlsx")).alias("name"))
    return ingest.pair_by_year(data, books)


@query("catalog_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{g}' AS sources FROM {t}" for t, g in [
        ("region", "Places | Keys"), ("nation", "Places | Keys"), ("customer", "Parties"), ("supplier", "Parties"),
        ("part", "(não mapeado)"), ("orders", "Trade"), ("lineitem", "Trade"), ("events", "(não mapeado)"),
        ("documents", "Texts"), ("conversations", "Texts"), ("pages", "Texts"), ("benchmark", "Texts"),
        ("labels", "Texts"), ("embeddings", "(não mapeado)")]))
def catalog_counts(spark, folder):
    groups = {"region": "places", "nation": "places", "customer": "parties", "supplier": "parties", "part": "goods",
              "orders": "trade", "lineitem": "trade", "events": "log", "documents": "texts", "conversations": "texts",
              "pages": "texts", "benchmark": "texts", "labels": "texts", "embeddings": "log"}
    sources = spark.createDataFrame(
        [("places", "Keys", 2), ("places", "Places", 1), ("parties", "Parties", 3), ("trade", "Trade", 4),
         ("texts", "Texts", 5)], "folder string, name string, position int")
    counts = table_counts(spark, {t: f"{folder}/{t}.parquet" for t in groups})
    placed = spark.createDataFrame(list(groups.items()), "table_name string, folder string")
    named = placed.join(publish.names_by_folder(sources), "folder", "left")
    return counts.join(named, "table_name", "left").select(
        "table_name", "n_rows", F.coalesce("names", F.lit(publish.UNMAPPED)).alias("sources"))




@query("nested_subsets", """
WITH codes AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) AS c FROM documents),
     sel AS (SELECT doc_id, list_has_any(c, [29]) AND NOT list_has_any(c, [35]) AS narrow,
                    list_has_any(c, [29, 27, 24]) AND NOT list_has_any(c, [35]) AS wide,
                    list_has_any(c, [29, 27, 24, 23, 22]) AND NOT list_has_any(c, [35]) AS widest FROM codes)
SELECT 'narrow' AS subset, count(*) FILTER (narrow) AS n, count(*) FILTER (narrow AND NOT wide) AS n_outside FROM sel
UNION ALL SELECT 'wide', count(*) FILTER (wide), count(*) FILTER (wide AND NOT widest) FROM sel
UNION ALL SELECT 'widest', count(*) FILTER (widest), 0 FROM sel
""")
def nested_subsets(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.transform(F.split("text", " "), F.length).alias("c"))
    picks = {"narrow": [29], "wide": [29, 27, 24], "widest": [29, 27, 24, 23, 22]}
    return relational.nested_counts(rows, {n: slices.selected(F.col("c"), codes, [35]) for n, codes in picks.items()})


@query("run_summary", """
SELECT o_orderstatus AS status, count(*) AS n_units, sum(floor(o_totalprice)::BIGINT)::BIGINT AS n_rows FROM orders GROUP BY 1
""")
def run_summary(spark, folder):
    status = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").cast("bigint").alias("n_rows"))
    return publish.run_summary(status)


@query("first_non_null", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW')) AS value FROM orders
""")
def first_non_null(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.coalesce(
        F.nullif(F.col("o_orderstatus"), F.lit("P")), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))).alias("value"))


@query("rename_drop_strip", """
SELECT p_partkey AS id, p_brand AS brand, p_type AS type FROM part
""")
def rename_drop_strip(spark, folder):
    rows = columns.drop(columns.rename(table(spark, folder, "part"), {"p_partkey": "id"}), "p_name", "p_size")
    return columns.strip_prefix(columns.subset(rows, ["id", "p_brand", "p_type"]), ["p_brand", "p_type"], 2)


