"""SQL that the queries must agree with, where SQL can say it."""

from cleartab.llm.secret_ledger import BASE, RULES

_DRAW = "((('0x' || substr(md5({0}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"

_OP5 = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS i
      FROM sized GROUP BY source),
w AS (SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
f AS (SELECT a.source, a.source_size, a.weight, a.cap,
             (SELECT sum(least(b.cap, b.weight * (a.cap / a.weight))) FROM w b)
               <= 1.5 * (SELECT sum(source_size) FROM w) AS is_full FROM w a),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE least(cap, weight *
        (1.5 * (SELECT sum(source_size) FROM f) - coalesce((SELECT sum(cap) FROM f WHERE is_full), 0))
        / (SELECT sum(weight) FROM f WHERE NOT is_full)) END::DOUBLE AS target FROM f),
r AS (SELECT d.*, t.source_size, t.target,
             row_number() OVER (PARTITION BY d.source ORDER BY size, md5(doc_id::VARCHAR)) AS k,
             coalesce(t.target / nullif(t.source_size, 0), 0) AS e,
             {draw} AS u
      FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(k * e + u) - floor((k - 1) * e + u)) * size)::BIGINT AS taken FROM r
""".format(draw=_DRAW.format("concat_ws('/', 'mix', coalesce(d.source, ''))"))

def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _op1() -> str:
    """Matches and the pieces between them, numbered; running lengths place them."""
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, '{r.kind}' AS kind, {i} AS o, {r.least} AS least, "
        f"regexp_extract_all(t, {_quoted(r.pattern)}, 0) AS whole, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS part, "
        f"string_split_regex(t, {_quoted(r.pattern)}) AS between FROM d" for i, r in enumerate(RULES))
    base = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({kinds}),
one AS (SELECT doc_id, kind, o, least, unnest(whole) AS whole, unnest(part) AS part, unnest(between[1:len(whole)]) AS gap,
               unnest(range(len(whole))) AS i FROM found WHERE len(whole) > 0),
placed AS (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, o ORDER BY i) AS stop FROM one),
span AS (SELECT doc_id, kind, o, stop - length(whole) AS start, stop FROM placed WHERE length(part) >= least),
said AS (SELECT doc_id, {base}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans,
                string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < {len(BASE)}) AS base FROM span GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN said USING (doc_id)
"""


_OP8 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM w WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                    GROUP BY ALL) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= 90 * (p.n + q.n - common)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN r ON r.id = doc_id GROUP BY doc_id
"""

_OP11 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
             sum(12 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + 1
                 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11) AS chars,
             string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                        ORDER BY turn, role, text) AS turns
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256,
       chars::BIGINT AS formatted_chars, regexp_full_match(turns, 's?(ua)+') AS valid FROM t
"""

_OP12 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor, a.label AS own, b.vec_id AS other, b.label,
                          list_inner_product(a.v, b.v)::BIGINT AS score
                   FROM (SELECT * FROM e WHERE vec_id % 100 = 0) a JOIN e b ON a.vec_id <> b.vec_id),
p AS (SELECT anchor, other, score FROM s WHERE own = label
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other)::INTEGER AS rank
FROM p JOIN s ON s.anchor = p.anchor AND s.own <> s.label AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""

_OP13 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
w AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT f.lang, f.phrase, f.a, k, string_split(f.phrase, ' ') AS p, n.n FROM f JOIN n USING (lang) WHERE k > 1),
cut AS (SELECT c.*, i, array_to_string(p[1:i], ' ') AS x, array_to_string(p[i + 1:], ' ') AS y
        FROM (SELECT c.*, unnest(range(1, k)) AS i FROM c) c),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.k, cut.p, cut.n, fx.a AS l, fy.a AS r,
             ((1000::HUGEINT * cut.a * cut.n) // (fx.a::HUGEINT * fy.a))::BIGINT AS score
      FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y
      QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, i) = 1),
held AS (SELECT DISTINCT lang, sub AS phrase, a FROM (
           SELECT lang, a, k, unnest(list_transform(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: [i, m]))),
                                                    lambda z: array_to_string(p[z[1]:z[1] + z[2] - 1], ' '))) AS sub FROM c WHERE k > 2))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s WHERE NOT EXISTS (FROM held WHERE held.lang = s.lang AND held.phrase = s.phrase AND held.a >= s.a) QUALIFY rank <= 2000
"""

ORACLES = {"op1_secret_ledger": _op1(), "op5_systematic_mix": _OP5, "op8_prefix_tree_join": _OP8,
           "op11_chat_records": _OP11, "op12_threshold_negatives": _OP12, "op13_collocations": _OP13}
