"""Dates, codes, text and numbers, row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from cleartab.functions import codes, dates, text
from cleartab.queries import query, table
from cleartab.sources.text import slice_lines

_DAY_TEXTS = """(SELECT o_orderkey, CASE o_orderkey % 7
    WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '%Y') || '0230'
    WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d 10:15:00')
  END AS day FROM orders)"""


def _day_texts(spark, folder):
    date, key = F.col("o_orderdate"), F.col("o_orderkey") % 7
    day = (F.when(key == 0, F.date_format(date, "yyyyMMdd")).when(key == 1, F.date_format(date, "yyyy-MM-dd"))
           .when(key == 2, F.date_format(date, "yyyy"))
           .when(key == 3, F.concat(F.date_format(date, "yyyy"), F.lit("0230")))
           .when(key == 4, F.date_format(date, "yyyy/MM/dd"))
           .when(key == 5, F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" 10:15:00"))))
    return table(spark, folder, "orders").select("o_orderkey", day.alias("day"))


# Every day of the years in question with the ways to write it, to look texts up in.
CALENDAR = """calendar AS (SELECT d::DATE AS d, strftime(d, '%Y%m%d') AS compact, strftime(d, '%Y-%m-%d') AS iso
  FROM range(TIMESTAMP '1900-01-01', TIMESTAMP '2100-01-01', INTERVAL 1 DAY) AS days(d)),
written AS (SELECT d, compact AS form FROM calendar UNION ALL SELECT d, iso FROM calendar)"""


@query("date_two_formats", f"""
WITH {CALENDAR}
SELECT o_orderkey, d AS day
FROM (SELECT o_orderkey, regexp_replace(replace(day, '/', '-'), ' .*', '') AS form FROM {_DAY_TEXTS})
LEFT JOIN written USING (form)
""")
def date_two_formats(spark, folder):
    return _day_texts(spark, folder).select(
        "o_orderkey", dates.date_two_formats(F.col("day")).alias("day"))


@query("date_consistency", f"""
WITH {CALENDAR}
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN d <= DATE '1998-06-15' END AS consistent
FROM (SELECT o_orderkey, regexp_replace(replace(day, '/', '-'), ' .*', '') AS form FROM {_DAY_TEXTS})
LEFT JOIN written USING (form)
""")
def date_consistency(spark, folder):
    limit = F.when(F.col("o_orderkey") % 5 != 0, F.lit("1998-06-15").cast("date"))
    return _day_texts(spark, folder).select("o_orderkey", dates.dates_consistent(
        dates.date_two_formats(F.col("day")), limit).alias("consistent"))


_MOMENTS = """(SELECT event_id, CASE event_id % 9
    WHEN 0 THEN strftime(ts, '%Y%m%d%H%M%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z'
    WHEN 2 THEN (epoch_us(ts) // 1000)::VARCHAR WHEN 3 THEN (epoch_us(ts) // 1000000)::VARCHAR
    WHEN 4 THEN '19891231000000' WHEN 5 THEN strftime(ts, '%Y') || '0230000000'
    WHEN 6 THEN strftime(ts, '%Y%m%d') || '256060' WHEN 7 THEN strftime(ts, '%Y%m%d%H%M%S') || chr(10)
  END AS moment,
  lpad(event_id::VARCHAR, 9, '0') || (CASE WHEN event_id % 4 = 0 THEN 1950 ELSE 1995 + event_id % 25 END)
    || CASE WHEN event_id % 5 = 0 THEN '826000' ELSE '8260001' END AS number
  FROM events)"""
# The date of each moment, looked up: by all fourteen digits of a valid time, by the day before a T, or by the
# day that a count of milliseconds falls into.
_DATED = f"""WITH {CALENDAR}, moments AS (SELECT * FROM {_MOMENTS}),
by_digits AS (SELECT event_id, d FROM moments JOIN calendar ON compact = substr(moment, 1, 8)
  WHERE length(moment) = 14 AND substr(moment, 9, 2) < '24' AND substr(moment, 11, 2) < '60'
    AND substr(moment, 13, 2) < '60' AND NOT regexp_matches(moment, '[^0-9]')),
by_iso AS (SELECT event_id, d FROM moments JOIN calendar ON starts_with(moment, iso || 'T')),
by_count AS (SELECT event_id, d FROM (SELECT event_id, moment::BIGINT // 86400000 AS n FROM moments
  WHERE length(moment) BETWEEN 10 AND 13 AND NOT regexp_matches(moment, '[^0-9]')) JOIN calendar ON epoch(d) = n * 86400),
dated AS (SELECT event_id, moment, number, d FROM moments LEFT JOIN (
  SELECT * FROM by_digits UNION ALL SELECT * FROM by_iso UNION ALL SELECT * FROM by_count) USING (event_id))"""


def _moments(spark, folder):
    ts, key = F.col("ts"), F.col("event_id") % 9
    day = F.date_format(ts, "yyyyMMdd")
    seconds = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + (
        F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.extract(F.lit("SECOND"), ts)))
    millis = seconds * 1000 + F.date_format(ts, "SSS").cast("bigint")
    moment = (
        F.when(key == 0, F.date_format(ts, "yyyyMMddHHmmss"))
        .when(key == 1, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T"), F.date_format(ts, "HH:mm:ss"), F.lit(".000Z")))
        .when(key == 2, millis.cast("string")).when(key == 3, seconds.cast("string"))
        .when(key == 4, "19891231000000")
        .when(key == 5, F.concat(F.date_format(ts, "yyyy"), F.lit("0230000000")))
        .when(key == 6, F.concat(day, F.lit("256060")))
        .when(key == 7, F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lit("\n"))))
    event = F.col("event_id")
    year = F.when(event % 4 == 0, F.lit(1950)).otherwise(1995 + event % 25).cast("string")
    tail = F.when(event % 5 == 0, "826000").otherwise("8260001")
    number = F.concat(F.lpad(event.cast("string"), 9, "0"), year, tail)
    return table(spark, folder, "events").select("event_id", moment.alias("moment"), number.alias("number"))


@query("date_three_formats", f"""
{_DATED}
SELECT event_id, moment, CASE WHEN year(d) BETWEEN 1990 AND 2026 THEN d END AS day FROM dated
""")
def date_three_formats(spark, folder):
    day = dates.within_years(dates.date_three_formats(F.col("moment")), 1990, 2026)
    return _moments(spark, folder).select("event_id", "moment", day.alias("day"))


@query("year_fallback", f"""
{_DATED}
SELECT event_id, coalesce(year(d), y)::BIGINT AS year,
       CASE WHEN d IS NOT NULL THEN 'DATA' WHEN y IS NOT NULL THEN 'NUMERO_PROCESSO' END AS origin
FROM (SELECT event_id, CASE WHEN year(m) BETWEEN 1990 AND 2026 THEN m END AS d,
             CASE WHEN n BETWEEN 1990 AND 2026 THEN n END AS y
      FROM (SELECT event_id, d AS m, CASE WHEN length(number) = 20 THEN substr(number, 10, 4)::INTEGER END AS n
            FROM dated))
""")
def year_fallback(spark, folder):
    d, y = F.col("d"), F.col("y")
    rows = _moments(spark, folder).select(
        "event_id", dates.within_years(dates.date_three_formats(F.col("moment")), 1990, 2026).alias("d"),
        dates.year_in_number(F.col("number"), 1990, 2026).alias("y"))
    return rows.select("event_id", dates.year_with_fallback(d, y).cast("bigint").alias("year"),
                       dates.year_origin(d, y, "DATA", "NUMERO_PROCESSO").alias("origin"))


@query("timestamp_text", """
SELECT event_id, strftime(TRY_CAST(raw AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS shown
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a time'
             ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.250Z' END AS raw FROM events)
""")
def timestamp_text(spark, folder):
    ts = F.col("ts")
    raw = F.when(F.col("event_type") == "error", "not a time").otherwise(
        F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T"), F.date_format(ts, "HH:mm:ss"), F.lit(".250Z")))
    return table(spark, folder, "events").select(
        "event_id", dates.timestamp_text(dates.timestamp_local(raw)).alias("shown"))


@query("age_code", """
WITH valid AS (SELECT u::VARCHAR || lpad(v::VARCHAR, 3, '0') AS code, CASE WHEN u = 4 THEN v ELSE 0 END::INTEGER AS age
               FROM range(1, 5) units(u), range(1000) ages(v) WHERE u < 4 OR v <= 120)
SELECT c_custkey, age
FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'A025' WHEN c_custkey % 13 = 0 THEN '402'
             ELSE (c_custkey % 6)::VARCHAR || lpad((c_custkey % 150)::VARCHAR, 3, '0') END AS code FROM customer) LEFT JOIN valid USING (code)
""")
def age_code(spark, folder):
    key = F.col("c_custkey")
    code = F.when(key % 11 == 0, "A025").when(key % 13 == 0, "402").otherwise(
        F.concat((key % 6).cast("string"), F.lpad((key % 150).cast("string"), 3, "0")))
    return table(spark, folder, "customer").select("c_custkey", codes.age_in_years(code).alias("age"))


@query("code_split", """
SELECT p_partkey, MAP {'ECO': 'economy', 'LAR': 'large', 'SMA': 'small'}[head] AS head_label,
       CASE WHEN head NOT IN ('ECO') THEN MAP {'0': 'zero', '1': 'one', '2': 'two'}[tail] END AS place,
       CASE WHEN head IN ('ECO') THEN MAP {'0': 'none', '3': 'third'}[tail] END AS other
FROM (SELECT p_partkey, substr(p_type, 1, 3) AS head,
             CASE WHEN p_size > 10 THEN (p_size % 10)::VARCHAR ELSE '' END AS tail FROM part)
""")
def code_split(spark, folder):
    code = F.concat(F.substring("p_type", 1, 3), F.when(
        F.col("p_size") > 10, (F.col("p_size") % 10).cast("string")).otherwise(""))
    head, place, other = codes.split_code(
        code, {"ECO": "economy", "LAR": "large", "SMA": "small"}, {"0": "zero", "1": "one", "2": "two"},
        ["ECO"], {"0": "none", "3": "third"})
    return table(spark, folder, "part").select(
        "p_partkey", head.alias("head_label"), place.alias("place"), other.alias("other"))


@query("fixed_width", """
SELECT trim(substr(line, 1, 8)) AS id, trim(substr(line, 9, 12)) AS segment,
       CASE WHEN ltrim(substr(line, 21, 3), '0') = '' THEN '0' ELSE ltrim(substr(line, 21, 3), '0') END AS age,
       TRY_CAST(nullif(trim(substr(line, 24, 14)), '') AS DOUBLE) / 1e8 AS weight
FROM (SELECT rpad(c_custkey::VARCHAR, 8, ' ') || rpad(c_mktsegment, 12, ' ')
             || lpad((c_custkey % 100)::VARCHAR, 3, '0')
             || CASE WHEN c_custkey % 10 = 3 THEN repeat(' ', 14)
                     ELSE lpad((c_custkey * 12345678 % 9999999999)::VARCHAR, 14, '0') END AS line FROM customer)
""")
def fixed_width(spark, folder):
    key = F.col("c_custkey")
    line = F.concat(
        F.rpad(key.cast("string"), 8, " "), F.rpad("c_mktsegment", 12, " "),
        F.lpad((key % 100).cast("string"), 3, "0"),
        F.when(key % 10 == 3, F.repeat(F.lit(" "), 14)).otherwise(
            F.lpad((key * 12345678 % 9999999999).cast("string"), 14, "0")))
    spans = {"id": (0, 8), "segment": (8, 20), "age": (20, 23), "weight": (23, 37)}
    rows = slice_lines(table(spark, folder, "customer").select(line.alias("line")), "line", spans)
    return rows.select("id", "segment", text.strip_leading_zeros(F.col("age")).alias("age"),
                       text.implied_decimals(F.col("weight")).alias("weight"))


_PLACEHOLDER = """CASE event_type WHEN 'click' THEN 'nan' WHEN 'view' THEN '' WHEN 'error' THEN 'None'
                  ELSE event_type END"""


@query("null_placeholders", f"""
SELECT event_id::VARCHAR AS event_id, CASE WHEN kind NOT IN ('nan', '', 'None') THEN kind END AS kind,
       CASE WHEN w = floor(w) THEN w::BIGINT::VARCHAR ELSE w::VARCHAR END AS half
FROM (SELECT event_id, {_PLACEHOLDER} AS kind, floor(value) / 2 AS w FROM events)
""")
def null_placeholders(spark, folder):
    kind = F.col("event_type")
    rows = table(spark, folder, "events").select(
        "event_id", F.when(kind == "click", "nan").when(kind == "view", "").when(kind == "error", "None")
        .otherwise(kind).alias("kind"), (F.floor("value").cast("double") / 2).alias("half"))
    return text.uniform_text(rows)


@query("whole_number_text", """
SELECT p_partkey, CASE WHEN v = floor(v) THEN v::BIGINT::VARCHAR ELSE v::VARCHAR END AS shown,
       TRY_CAST(CASE WHEN p_size > 40 THEN p_size || '.5' WHEN p_size > 30 THEN 'x' || p_size
                     WHEN p_size > 20 THEN p_size || '.0' ELSE p_size::VARCHAR END AS INTEGER) AS parsed
FROM (SELECT *, floor(p_retailprice) / 4 AS v FROM part)
""")
def whole_number_text(spark, folder):
    size = F.col("p_size").cast("string")
    raw = (F.when(F.col("p_size") > 40, F.concat(size, F.lit(".5")))
           .when(F.col("p_size") > 30, F.concat(F.lit("x"), size))
           .when(F.col("p_size") > 20, F.concat(size, F.lit(".0"))).otherwise(size))
    quarter = F.floor("p_retailprice").cast("double") / 4
    return table(spark, folder, "part").select(
        "p_partkey", text.whole_number_text(quarter).alias("shown"),
        text.try_integer(raw, "int").alias("parsed"))


@query("text_clean", r"""
SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean,
       trim(regexp_replace(regexp_replace('Idade' || chr(10) || ' (Ver VD_' || source || ')  ' || lang,
            '\(\s*[Vv]er[^)]*\)', '', 'g'), '\s+', ' ', 'g')) AS label
FROM documents
""")
def text_clean(spark, folder):
    label = F.concat(F.lit("Idade\n (Ver VD_"), "source", F.lit(")  "), "lang")
    return table(spark, folder, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("clean"),
        text.drop_cross_reference(label).alias("label"))


@query("slug", """
SELECT doc_id, coalesce(nullif(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '_', 'g'), '_'), ''),
       'coluna') AS slug FROM documents
""")
def slug(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query("normal_code", """
SELECT c_custkey, trim(code) AS code,
       CASE WHEN v = floor(v) THEN v::BIGINT::VARCHAR ELSE v::VARCHAR END AS number
FROM (SELECT c_custkey, ' ' || c_nationkey || '  ' AS code, c_nationkey / 2 AS v FROM customer)
""")
def normal_code(spark, folder):
    raw = F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit("  "))
    half = F.col("c_nationkey").cast("double") / 2
    return table(spark, folder, "customer").select(
        "c_custkey", text.normal_code(raw).alias("code"),
        text.normal_code(half, numeric=True).alias("number"))


@query("file_period", """
SELECT o_orderkey, name, CASE WHEN digits = '' THEN name WHEN length(digits) <> 2 THEN digits
         WHEN digits >= '90' THEN '19' || digits ELSE '20' || digits END AS period,
       regexp_full_match(upper(name), 'DOEXT[0-9]+[.]DBC') AS is_source,
       is_source AND TRY_CAST(period AS INTEGER) BETWEEN 1996 AND 2000 AS in_years
FROM (SELECT o_orderkey, name, regexp_extract(name, '([0-9]+)[.][A-Za-z0-9_]+$', 1) AS digits
      FROM (SELECT o_orderkey, CASE o_orderpriority
              WHEN '1-URGENT' THEN 'DOEXT' || strftime(o_orderdate, '%y') || '.dbc'
              WHEN '2-HIGH' THEN 'doext' || strftime(o_orderdate, '%Y') || '.DBC'
              WHEN '3-MEDIUM' THEN 'viol' || strftime(o_orderdate, '%Y') || '.DBC'
              ELSE 'readme.txt' END AS name FROM orders))
""")
def file_period(spark, folder):
    from cleartab.operators.ingest import matches_source

    kind, date = F.col("o_orderpriority"), F.col("o_orderdate")
    name = (F.when(kind == "1-URGENT", F.concat(F.lit("DOEXT"), F.date_format(date, "yy"), F.lit(".dbc")))
            .when(kind == "2-HIGH", F.concat(F.lit("doext"), F.date_format(date, "yyyy"), F.lit(".DBC")))
            .when(kind == "3-MEDIUM", F.concat(F.lit("viol"), F.date_format(date, "yyyy"), F.lit(".DBC")))
            .otherwise("readme.txt"))
    rows = table(spark, folder, "orders").select("o_orderkey", name.alias("name"))
    return rows.select("o_orderkey", "name", dates.period_key(F.col("name")).alias("period"),
                       matches_source(F.col("name"), "DOEXT", "DBC").alias("is_source"),
                       matches_source(F.col("name"), "DOEXT", "DBC", 1996, 2000).alias("in_years"))
