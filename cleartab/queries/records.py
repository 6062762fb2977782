"""Versions, code lookups, lists and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from cleartab.functions import codes, jsonfields, lists
from cleartab.operators import ordered, relational, versions
from cleartab.queries import query, table

PRIORITY = {7: 10, 30: 20, 31: 21, 12: 30, 3: 31}
CORE, CONTEXT, ATTEMPT, SIGN = [12, 3], [30, 31, 40], [7], [45]
_RANK = "MAP {7: 10, 30: 20, 31: 21, 12: 30, 3: 31}"


@query("flagship_subject_flags", f"""
WITH latest AS (
  SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, l_partkey DESC) = 1),
names AS (
  SELECT p_size AS code, min(CASE WHEN p_size <= 40 THEN p_name END) AS name
  FROM part GROUP BY p_size),
firsts AS (
  SELECT l_orderkey, p_size AS code, min(l_linenumber) AS pos
  FROM latest JOIN part ON p_partkey = l_partkey GROUP BY ALL),
labelled AS (
  SELECT f.*, coalesce({_RANK}[f.code], 99) AS rank,
         coalesce(n.name, 'ASSUNTO ' || f.code) AS label
  FROM firsts f LEFT JOIN names n USING (code)),
per_order AS (
  SELECT l_orderkey, count(*) AS n_codes,
         string_agg(label, ', ' ORDER BY rank, pos) AS subjects,
         string_agg(code::VARCHAR, ', ' ORDER BY code) AS code_text,
         bool_or(code IN (12, 3)) AS has_core,
         bool_or(code IN (30, 31, 40)) AS has_context,
         bool_or(code = 7) AS attempt, bool_or(code = 45) AS sign
  FROM labelled GROUP BY l_orderkey)
SELECT l_orderkey, n_codes, subjects, code_text, has_core, has_context,
       CASE WHEN attempt THEN 'TENTATIVA' WHEN sign THEN 'CONSUMADO' END AS outcome
FROM per_order
""")
def flagship(spark, folder):
    """Latest order lines, the subject list of each order with learned names,
    flags and outcome.

    Codes are reduced to one row per order and code before lists are built, so a
    list holds distinct codes only, however many lines an order has.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    latest = versions.latest_version(lines, ["l_orderkey", "l_linenumber"],
                                     [F.col("l_shipdate").desc(), F.col("l_partkey").desc()])
    names = versions.learn_names(parts.select(
        F.col("p_size").alias("code"), F.when(F.col("p_size") <= 40, F.col("p_name")).alias("name")))
    firsts = (latest.join(parts.drop("p_name"), F.col("l_partkey") == F.col("p_partkey"))
              .groupBy("l_orderkey", F.col("p_size").alias("code"))
              .agg(F.min("l_linenumber").alias("pos")))
    listed = (firsts.groupBy("l_orderkey")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("l"))
              .select("l_orderkey", F.transform("l", lambda s: s["code"]).alias("codes")))
    ordered_codes = listed.withColumn("by_rank", lists.by_priority(F.col("codes"), PRIORITY))
    named = versions.name_lists(ordered_codes, "l_orderkey", "by_rank", names, "ASSUNTO ", "subjects")
    c = F.col("codes")
    return named.select(
        "l_orderkey", F.size(c).cast("bigint").alias("n_codes"), "subjects",
        lists.distinct_sorted_text(c).alias("code_text"),
        lists.has_any(c, CORE).alias("has_core"), lists.has_any(c, CONTEXT).alias("has_context"),
        codes.outcome(lists.has_any(c, ATTEMPT), lists.has_any(c, SIGN)).alias("outcome"))


@query("latest_version", """
SELECT event_id, nullif(user_id, 8) AS user_key, ts, event_type, value FROM events
QUALIFY user_key IS NULL
  OR row_number() OVER (PARTITION BY user_key ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_version(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.nullif(F.col("user_id"), F.lit(8)).alias("user_key"), "ts", "event_type", "value")
    return versions.latest_version(rows, ["user_key"], [F.col("ts").desc(), F.col("event_id").desc()])


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]


@query("lookup_null", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       MAP {'A': 'ACCEPTED', 'R': 'RETURNED'}[l_returnflag] AS label FROM lineitem
""")
def lookup_null(spark, folder):
    book = {"A": "ACCEPTED", "R": "RETURNED"}
    return table(spark, folder, "lineitem").select(
        *_LINE, codes.lookup(F.col("l_returnflag"), book).alias("label"))


@query("lookup_fallback", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       coalesce(MAP {'A': 'ACCEPTED', 'R': 'RETURNED'}[l_returnflag], l_returnflag) AS label
FROM lineitem
""")
def lookup_fallback(spark, folder):
    rows = table(spark, folder, "lineitem").select(*_LINE, F.col("l_returnflag").alias("label"))
    return codes.decode(rows, {"label": {"A": "ACCEPTED", "R": "RETURNED"}})


@query("lookup_default", """
SELECT o_orderkey, coalesce(MAP {'F': 10, 'P': 20}[nullif(o_orderstatus, 'P')], 99) AS rank,
       coalesce(MAP {'F': 'FINAL'}[o_orderstatus], 'STATUS ' || o_orderstatus) AS label FROM orders
""")
def lookup_default(spark, folder):
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        codes.lookup(F.nullif(status, F.lit("P")), {"F": 10, "P": 20}, "default", 99).alias("rank"),
        codes.lookup(status, {"F": "FINAL"}, "default", F.concat(F.lit("STATUS "), status)).alias("label"))


@query("lookup_broadcast", """
SELECT c_custkey, n_name AS nation_name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) ON n_nationkey = c_nationkey
""")
def lookup_broadcast(spark, folder):
    book = table(spark, folder, "nation").filter("n_regionkey <> 3")
    rows = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return codes.lookup_table(rows, "c_nationkey", book, "n_nationkey", "n_name",
                              "nation_name").drop("c_nationkey")


@query("multi_mark_list", """
WITH line AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM lineitem),
mark AS (
  SELECT r, 'REDUCED' AS label FROM line WHERE l_discount >= 0.05
  UNION SELECT r, 'REDUCED' FROM line WHERE l_returnflag = 'R'
  UNION SELECT r, 'TAXED' FROM line WHERE l_tax >= 0.06
  UNION SELECT r, 'BULK' FROM line WHERE l_quantity >= 40),
found AS (SELECT r, string_agg(label, ', ' ORDER BY label) AS labels, count(*) AS n FROM mark GROUP BY r)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, labels, coalesce(n, 0) AS n_labels
FROM line LEFT JOIN found USING (r)
""")
def multi_mark_list(spark, folder):
    def mark(condition):
        return F.when(condition, "1").otherwise("2")

    rows = table(spark, folder, "lineitem").select(
        *_LINE[:4], mark(F.col("l_discount") >= 0.05).alias("m1"), mark(F.col("l_tax") >= 0.06).alias("m2"),
        mark(F.col("l_quantity") >= 40).alias("m3"), mark(F.col("l_returnflag") == "R").alias("m4"))
    marks = rows.withColumn("marks", lists.marked_labels(
        {"m1": "REDUCED", "m2": "TAXED", "m3": "BULK", "m4": "REDUCED"}))
    return marks.select(*_LINE[:4], lists.join_list(F.col("marks")).alias("labels"),
                        F.size("marks").cast("bigint").alias("n_labels"))


@query("flag_any", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(a = 'Sim', false) OR coalesce(b = 'Sim', false) AS any_yes,
       coalesce(a IN ('Sim', 'Talvez'), false) OR coalesce(b IN ('Sim', 'Talvez'), false) AS any_in,
       coalesce(a = 'Sim' OR b = 'Sim', false) AS flagged
FROM (SELECT *, CASE WHEN l_quantity > 45 THEN 'Sim' WHEN l_quantity > 25 THEN 'Não'
                     WHEN l_quantity > 15 THEN 'Talvez' END AS a,
             CASE WHEN l_returnflag = 'A' THEN 'Sim' WHEN l_returnflag = 'N' THEN 'Não' END AS b
      FROM lineitem)
""")
def flag_any(spark, folder):
    quantity, state = F.col("l_quantity"), F.col("l_returnflag")
    rows = table(spark, folder, "lineitem").withColumns({
        "a": F.when(quantity > 45, "Sim").when(quantity > 25, "Não").when(quantity > 15, "Talvez"),
        "b": F.when(state == "A", "Sim").when(state == "N", "Não")})
    return rows.select(*_LINE[:4], lists.any_equal(["a", "b"], "Sim").alias("any_yes"),
                       lists.any_in(["a", "b"], ["Sim", "Talvez"]).alias("any_in"),
                       codes.flag(codes.any_marked(["a", "b"], "Sim")).alias("flagged"))


@query("flag_three_state", """
SELECT event_id, CASE WHEN a = '1' OR b IN ('1', '01') THEN 'SIM'
                      WHEN a IN ('1', '2') OR c IN ('1', '2') THEN 'NAO' END AS state
FROM (SELECT event_id,
        CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'signup' THEN '9' END AS a,
        CASE WHEN value < 10 THEN '01' WHEN value < 20 THEN '03' END AS b,
        CASE WHEN value > 30 THEN '2' ELSE '9' END AS c FROM events)
""")
def flag_three_state(spark, folder):
    kind, value = F.col("event_type"), F.col("value")
    rows = table(spark, folder, "events").select(
        "event_id", codes.lookup(kind, {"click": "1", "view": "2", "signup": "9"}).alias("a"),
        F.when(value < 10, "01").when(value < 20, "03").alias("b"),
        F.when(value > 30, "2").otherwise("9").alias("c"))
    yes = (F.col("a") == "1") | F.col("b").isin("1", "01")
    return rows.select("event_id", codes.three_state(yes, codes.answered(["a", "c"])).alias("state"))


@query("filter_keep_null", """
SELECT event_id, nullif(event_type, 'signup') AS kind FROM events WHERE kind IS DISTINCT FROM 'error'
""")
def filter_keep_null(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("signup")).alias("kind"))
    return rows.filter(codes.not_equal_or_null(F.col("kind"), "error"))


_CODE_SQL = "upper(substr(p_type, 1, 3)) || CASE WHEN p_size > 25 THEN (p_size % 10)::VARCHAR ELSE '' END"


@query("code_set_semi", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, code FROM lineitem
JOIN (SELECT p_partkey, {_CODE_SQL} AS code FROM part) ON p_partkey = l_partkey
WHERE code IN ('ECO', 'SMA') OR regexp_full_match(code, 'ECO[0-4]|LAR[5-9]')
""")
def code_set_semi(spark, folder):
    wanted = ["ECO", "SMA", *[f"ECO{i}" for i in range(5)], *[f"LAR{i}" for i in range(5, 10)]]
    code = F.concat(F.upper(F.substring("p_type", 1, 3)),
                    F.when(F.col("p_size") > 25, (F.col("p_size") % 10).cast("string")).otherwise(""))
    parts = table(spark, folder, "part").select("p_partkey", code.alias("code"))
    chosen = relational.in_codes(parts, "code", spark.createDataFrame([(w,) for w in wanted], "code string"))
    lines = table(spark, folder, "lineitem").select(*_LINE[:4])
    return lines.join(chosen, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


# Words of a text as numbers: their lengths, with the long ones unknown.
_WORDS_SQL = ("list_transform(string_split(text, ' '), "
              "lambda w: CASE WHEN length(w) <= 12 THEN length(w)::INTEGER END)")


def _word_codes():
    return F.transform(F.split("text", " "), lambda w: F.when(F.length(w) <= 12, F.length(w)))


# One row per word of a text, in order.
_WORD_ROWS = """word AS (SELECT doc_id, unnest(codes) AS code, generate_subscripts(codes, 1) AS pos FROM coded)"""


@query("list_codes_text", f"""
WITH coded AS (SELECT doc_id, {_WORDS_SQL} AS codes FROM documents), {_WORD_ROWS},
short AS (SELECT doc_id, string_agg(code::VARCHAR, ', ' ORDER BY code) AS code_text
          FROM (SELECT DISTINCT doc_id, code FROM word WHERE code IS NOT NULL) GROUP BY doc_id),
long AS (SELECT doc_id, string_agg(code::VARCHAR, '|' ORDER BY pos) AS long_text FROM word WHERE code > 11 GROUP BY doc_id)
SELECT doc_id, len(codes) AS n_codes, len(codes) > 400 AS implausible, code_text, long_text
FROM coded LEFT JOIN short USING (doc_id) LEFT JOIN long USING (doc_id)
""")
def list_codes_text(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", _word_codes().alias("codes"))
    c = F.col("codes")
    return rows.select(
        "doc_id", lists.list_size(c).cast("bigint").alias("n_codes"),
        (lists.list_size(c) > 400).alias("implausible"),
        lists.distinct_sorted_text(c).alias("code_text"),
        lists.join_list(F.transform(F.filter(c, lambda x: x > 11), lambda x: x.cast("string")), "|")
        .alias("long_text"))


@query("list_priority", f"""
WITH coded AS (SELECT doc_id, {_WORDS_SQL} AS codes FROM documents), {_WORD_ROWS},
rule(code, rank) AS (VALUES (9, 10), (4, 20), (5, 20), (0, 30)),
title(code, name) AS (VALUES (4, 'four'), (5, 'five'), (9, 'nine')),
first AS (SELECT doc_id, code, min(pos) AS pos FROM word WHERE code IS NOT NULL GROUP BY doc_id, code),
named AS (SELECT doc_id, string_agg(coalesce(name, 'ASSUNTO ' || code), ', ' ORDER BY coalesce(rank, 99), pos) AS names
          FROM first LEFT JOIN rule USING (code) LEFT JOIN title USING (code) GROUP BY doc_id),
seen AS (SELECT doc_id, count(*) FILTER (code IN (11, 12)) > 0 AS has_long, count(*) FILTER (code = 99) > 0 AS has_none
         FROM word GROUP BY doc_id)
SELECT doc_id, has_long, has_none, names FROM seen LEFT JOIN named USING (doc_id)
""")
def list_priority(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", _word_codes().alias("codes"))
    ranked = lists.by_priority(F.col("codes"), {9: 10, 4: 20, 5: 20, 0: 30})
    names = codes.literal_map({4: "four", 5: "five", 9: "nine"})
    return rows.select(
        "doc_id", lists.has_any(F.col("codes"), [11, 12]).alias("has_long"),
        lists.has_any(F.col("codes"), [99]).alias("has_none"),
        lists.join_list(lists.named(ranked, names, "ASSUNTO ")).alias("names"))


@query("parallel_unnest", """
SELECT DISTINCT line, sentence FROM (
  SELECT unnest(list_transform(string_split(text, chr(10)), lambda x: length(x)::INTEGER)) AS line,
         unnest(list_transform(string_split(text, '. '), lambda x: length(x)::INTEGER)) AS sentence
  FROM documents)
""")
def parallel_unnest(spark, folder):
    rows = table(spark, folder, "documents").select(
        F.transform(F.split("text", "\n"), F.length).alias("a"),
        F.transform(F.split("text", r"\. "), F.length).alias("b"))
    return rows.select(lists.unnest(F.col("a"), F.col("b"), ("line", "sentence"))).distinct()


@query("learn_dictionary", """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
uneven AS (SELECT DISTINCT doc_id FROM w WHERE word = '')
SELECT length(word)::INTEGER AS code, min(word) AS name FROM w ANTI JOIN uneven USING (doc_id) GROUP BY length(word)
""")
def learn_dictionary(spark, folder):
    words = F.split("text", " ")
    pairs = versions.pairs_from_lists(
        table(spark, folder, "documents"), F.transform(words, F.length),
        F.filter(words, lambda w: w != ""))
    return versions.learn_names(pairs)


_PROPS = """(SELECT event_id, CASE k % 9
    WHEN 0 THEN '[{"codigo":' || k || ',"nome":"n' || k || '"},[{"codigo":"' || (k + 1) || '"}],{"codigo":null},{"nome":"x"},{"codigo":"x"}]'
    WHEN 1 THEN '{"codigo":' || k || ',"nome":"bare"}'
    WHEN 2 THEN '[[[{"codigo":' || k || '}],{"codigo":7}],{"codigo":5.6}]'
    WHEN 3 THEN '[]' WHEN 4 THEN 'null'
    WHEN 5 THEN '[[[[[{"codigo":' || k || '}]]]],{"codigo":1}]'
    WHEN 6 THEN '[[[[[[[{"codigo":' || k || '}],{"codigo":2}]]]]]]'
    WHEN 7 THEN '[{"codigo":' || k || ',"nome":"[{","filho":{"codigo":3,"neto":[{"codigo":4}]}},{"codigo":5}]' END AS subjects
  FROM (SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events))"""


@query("json_nested_codes", f"""
WITH p AS {_PROPS},
node AS (SELECT p.event_id, coalesce(TRY_CAST(t.atom AS INTEGER)::VARCHAR, '-') AS code, t.id, len(regexp_extract_all(t.fullkey, '[.\\[]')) AS depth
         FROM p, json_tree(p.subjects) t WHERE t.key = 'codigo'),
told AS (SELECT event_id, count(*) AS n, string_agg(code, ',' ORDER BY depth, id) AS codes FROM node GROUP BY event_id)
SELECT p.event_id, CASE WHEN subjects IS NOT NULL THEN coalesce(n, 0) END AS n_codes,
       CASE WHEN subjects IS NOT NULL THEN coalesce(n, 0) > 3 END AS many, CASE WHEN subjects IS NOT NULL THEN coalesce(codes, '') END AS code_text
FROM p LEFT JOIN told USING (event_id)
""")
def json_nested_codes(spark, folder):
    rows = table(spark, folder, "events").select("event_id", jsonfields.json_integer(F.col("props"), "k").alias("k"))
    k = F.col("k")
    t = k.cast("string")
    many = F.concat(F.lit('[{"codigo":'), t, F.lit(',"nome":"n'), t, F.lit('"},[{"codigo":"'),
                    (k + 1).cast("string"), F.lit('"}],{"codigo":null},{"nome":"x"},{"codigo":"x"}]'))
    deep = F.concat(F.lit('[[[{"codigo":'), t, F.lit('}],{"codigo":7}],{"codigo":5.6}]'))
    child = F.concat(F.lit('[{"codigo":'), t, F.lit(
        ',"nome":"[{","filho":{"codigo":3,"neto":[{"codigo":4}]}},{"codigo":5}]'))
    subjects = (F.when(k % 9 == 0, many)
                .when(k % 9 == 1, F.concat(F.lit('{"codigo":'), t, F.lit(',"nome":"bare"}')))
                .when(k % 9 == 2, deep).when(k % 9 == 3, "[]").when(k % 9 == 4, "null")
                .when(k % 9 == 5, F.concat(F.lit('[[[[[{"codigo":'), t, F.lit('}]]]],{"codigo":1}]')))
                .when(k % 9 == 6, F.concat(F.lit('[[[[[[[{"codigo":'), t, F.lit('}],{"codigo":2}]]]]]]')))
                .when(k % 9 == 7, child))
    rows = rows.select("event_id", subjects.alias("s"))
    c = F.col("codes")
    return rows.select("event_id", jsonfields.json_integers(F.col("s"), "codigo").alias("codes")).select(
        "event_id", lists.list_size(c).cast("bigint").alias("n_codes"),
        (lists.list_size(c) > 3).alias("many"),
        F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ",").alias("code_text"))


@query("json_nested_escapes", r"""
WITH d AS (SELECT event_id, CASE k % 5
    WHEN 0 THEN '[{"nome":"' || kind || '\\","filho":[[[{"codigo":' || k || '}]]]}]'
    WHEN 1 THEN '[{"nome":"}","f":{"codigo":' || k || '}}]'
    WHEN 2 THEN '[{"codigo":' || k || ',"nome":"a}b","f":{"codigo":2}},{"nome":"\"]{","codigo":3}]'
    WHEN 3 THEN '[{"nome":"[{\\\"","codigo":' || k || '},[{"codigo":4,"nome":"\\"}]]'
    ELSE '[{"nome":"' || kind || ' { \" [","codigo":' || k || '}]' END AS subjects
  FROM (SELECT event_id, event_type AS kind, json_extract_string(props, '$.k')::INTEGER AS k FROM events))
SELECT event_id, array_to_string(list_transform(json_extract(subjects, '$..codigo'), lambda c: c::VARCHAR), ',') AS code_text,
       array_to_string(json_extract_string(subjects, '$..nome'), '|') AS name_text FROM d
""")
def json_nested_escapes(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("kind"), jsonfields.json_integer(F.col("props"), "k").alias("k"))
    forms = [r'[{"nome":"#kind\\","filho":[[[{"codigo":#k}]]]}]', '[{"nome":"}","f":{"codigo":#k}}]',
             r'[{"codigo":#k,"nome":"a}b","f":{"codigo":2}},{"nome":"\"]{","codigo":3}]',
             r'[{"nome":"[{\\\"","codigo":#k},[{"codigo":4,"nome":"\\"}]]', r'[{"nome":"#kind { \" [","codigo":#k}]']
    form = F.element_at(F.array(*[F.lit(f) for f in forms]), (F.col("k") % 5 + 1).cast("int"))
    told = F.replace(F.replace(form, F.lit("#kind"), F.col("kind")), F.lit("#k"), F.col("k").cast("string"))
    found = rows.select("event_id", jsonfields.json_objects(told).alias("o"))
    return found.select("event_id", F.array_join(jsonfields.integers_of(F.col("o"), "codigo"), ",").alias("code_text"),
                        F.array_join(jsonfields.values_of(F.col("o"), "nome"), "|").alias("name_text"))


@query("json_path_num", """
SELECT event_id, TRY_CAST(json_extract_string(doc, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN replace(props, '}', '.6}')
             WHEN 'view' THEN replace(replace(props, ': ', ': "'), '}', '.0"}')
             WHEN 'error' THEN '{"k": "none"}' WHEN 'signup' THEN '{"j": 1}' ELSE props END AS doc
      FROM events)
""")
def json_path_num(spark, folder):
    kind, props = F.col("event_type"), F.col("props")
    doc = (F.when(kind == "click", F.replace(props, F.lit("}"), F.lit(".6}")))
           .when(kind == "view", F.replace(F.replace(props, F.lit(": "), F.lit(': "')), F.lit("}"), F.lit('.0"}')))
           .when(kind == "error", '{"k": "none"}').when(kind == "signup", '{"j": 1}').otherwise(props))
    return table(spark, folder, "events").select("event_id", jsonfields.json_integer(doc, "k").alias("k"))


@query("json_path_text", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS none,
       trim('"' || event_type || '"', '"') AS kind FROM events
""")
def json_path_text(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", jsonfields.json_text(F.col("props"), "k").alias("k"),
        jsonfields.json_text(F.col("props"), "none").alias("none"),
        jsonfields.unquote(F.concat(F.lit('"'), "event_type", F.lit('"'))).alias("kind"))


@query("forward_fill", """
SELECT conv_id, turn, last_value(mark IGNORE NULLS) OVER (
         PARTITION BY conv_id, part ORDER BY turn ROWS UNBOUNDED PRECEDING) AS current
FROM (SELECT conv_id, turn,
             CASE WHEN role = 'user' AND length(text) <= 700 THEN 'U' || turn END AS mark,
             sum((length(text) > 700)::INTEGER) OVER (PARTITION BY conv_id ORDER BY turn) AS part
      FROM conversations)
""")
def forward_fill(spark, folder):
    rows = table(spark, folder, "conversations")
    long = F.length("text") > 700
    value = F.when((F.col("role") == "user") & ~long, F.concat(F.lit("U"), F.col("turn").cast("string")))
    return ordered.forward_fill(rows, ["conv_id"], "turn", value, long, "current").select(
        "conv_id", "turn", "current")


@query("name_occurrence", """
SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS occurrence FROM part
""")
def name_occurrence(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return ordered.occurrence_number(rows, ["p_name"], "p_partkey", "occurrence")


@query("distinct_entities", """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_entities
FROM lineitem GROUP BY ALL
""")
def distinct_entities(spark, folder):
    return relational.row_and_entity_counts(
        table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_orderkey")
