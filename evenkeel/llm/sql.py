"""SQL twins of the corpus queries."""

SQL_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

SQL_QUALITY = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body, {SQL_WORDS.format('text')} AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM w),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (
  SELECT d.doc_id, source, len(ws)::BIGINT AS n_words,
    coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(body, '!')) AS n_marks,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN l ON d.doc_id = l.doc_id LEFT JOIN c ON d.doc_id = c.doc_id),
f AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
    n_symbols > 0.2 * n_words AS symbols, n_marks > 0.2 * n_words AS marks, n_dup_lines > 0.5 * n_lines AS lines FROM m),
h AS (
  SELECT source, rule, count(*) AS n, sum(failed::INT) AS failed FROM (
    SELECT source, unnest(['short', 'repetitive', 'symbols', 'marks', 'lines']) AS rule,
      unnest([short, repetitive, symbols, marks, lines]) AS failed FROM f) GROUP BY source, rule),
p AS (SELECT rule, sum(failed) / sum(n) AS mean, var_pop(failed / n) AS var, count(*) AS hosts FROM h GROUP BY rule),
k AS (
  SELECT rule, mean, CASE WHEN var > 0 AND hosts > 1 THEN greatest(mean * (1 - mean) / var - 1, 0) END AS weight FROM p),
v AS (
  SELECT source, max(coalesce((failed + mean * weight) / (n + weight), mean)) AS rate FROM h JOIN k ON h.rule = k.rule
  GROUP BY source)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
  NOT (short OR repetitive) AND NOT (symbols OR marks OR lines) AND rate <= 0.5 AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


def _sql_mixing(rounds: int = 12, power: float = 0.7) -> str:
    """Tokens per cell, raked round by round, one named step for each dimension of each round."""
    steps, last = [], "s0"
    for k in range(rounds):
        for d in ("source", "lang", "topic"):
            steps.append(
                f"{last}_{d[0]} AS MATERIALIZED (SELECT * REPLACE (w * goal_{d} / sum(w) OVER (PARTITION BY {d}) AS w) FROM {last})"
            )
            last = f"{last}_{d[0]}"
        steps.append(f"s{k + 1} AS MATERIALIZED (FROM {last})")
        last = f"s{k + 1}"
    goals = ", ".join(
        f"""g_{d} AS (SELECT {d}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () * any_value(total) AS goal_{d}
        FROM c GROUP BY {d})"""
        for d in ("source", "lang", "topic")
    )
    return rf"""
WITH t AS (
  SELECT doc_id, source, lang,
    CASE WHEN regexp_matches(coalesce(text, ''), '(?i)licen[cs]ed?|rights reserved') THEN 'licence'
      WHEN regexp_matches(coalesce(text, ''), '@[A-Za-z0-9-]+\.|\+[0-9] ') THEN 'contact'
      WHEN regexp_matches(coalesce(text, ''), '[|]') THEN 'table' ELSE 'prose' END AS topic,
    len({SQL_WORDS.format('text')})::BIGINT AS n_tokens FROM documents),
c AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, sum(sum(n_tokens)) OVER ()::DOUBLE AS total FROM t
  GROUP BY ALL HAVING sum(n_tokens) > 0),
{goals},
s0 AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, tokens, goal_source, goal_lang, goal_topic, tokens AS w FROM c
  JOIN g_source ON c.source IS NOT DISTINCT FROM g_source.source JOIN g_lang ON c.lang IS NOT DISTINCT FROM g_lang.lang
  JOIN g_topic ON c.topic = g_topic.topic),
{", ".join(steps)},
j AS (
  SELECT t.*, CASE WHEN n_tokens > 0 THEN coalesce(w / tokens, 1) ELSE 1.0 END AS wanted,
    ('0x' || substr(md5('mix|' || coalesce(t.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS draw
  FROM t LEFT JOIN {last} s ON t.source IS NOT DISTINCT FROM s.source AND t.lang IS NOT DISTINCT FROM s.lang
    AND t.topic = s.topic)
SELECT doc_id, source, lang, topic, n_tokens, round(least(wanted, 1), 9) AS probability,
  round(greatest(wanted, 1), 9) AS weight, draw < wanted AS kept FROM j
"""


SQL_MIXING = _sql_mixing()


SQL_LINES = rf"""
WITH l AS (
  SELECT doc_id, i - 1 AS pos, ls[i] AS line, regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) r(i)),
e AS (SELECT * FROM l WHERE len(w) > 0),
f AS (SELECT line, min(struct_pack(d := doc_id, p := pos)) AS fst, any_value(w) AS w FROM e GROUP BY line),
s AS (
  SELECT line, fst, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM f),
n AS (SELECT line, count(*) AS n FROM s GROUP BY line),
p AS (SELECT a.line AS x, b.line AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.fst < b.fst GROUP BY ALL),
m AS (
  SELECT DISTINCT y FROM p JOIN n nx ON nx.line = p.x JOIN n ny ON ny.line = p.y WHERE 5 * c >= 4 * (nx.n + ny.n - c)),
r AS (
  SELECT e.doc_id, e.pos, f.fst.d = e.doc_id AND f.fst.p = e.pos AND m.y IS NULL AS stays
  FROM e JOIN f ON e.line = f.line LEFT JOIN m ON m.y = e.line)
SELECT doc_id, count(*) AS compared, count(*) FILTER (NOT stays) AS n_removed,
  coalesce(string_agg(pos::VARCHAR, ',' ORDER BY pos) FILTER (NOT stays), '') AS removed
FROM r GROUP BY doc_id
"""


SQL_FIM = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
h AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3,
    ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form != 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""


SQL_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(e, lambda x: abs(x))) > 0),
l AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r != b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r, r AS o FROM v UNION SELECT reach.r, l.y FROM reach JOIN l ON l.x = reach.o),
c AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.o GROUP BY reach.r),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.r = v.r LEFT JOIN n ON n.x = v.r
"""


#: crc32 of a text of ASCII characters, bit by bit.
SQL_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
  list_concat([4294967295::UBIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::UBIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], list_resize([]::UBIGINT[], 8, 0::UBIGINT)),
    lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))))::BIGINT"""

SQL_RUNS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS.format('text')} AS ws, {SQL_CRC32.format("coalesce(doc_id::VARCHAR, '')")} AS h
  FROM documents),
a AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (
  SELECT r, n, CASE WHEN a IS NULL THEN ws
    ELSE list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS ws FROM p),
w AS MATERIALIZED (SELECT r, n, unnest(ws) AS w, unnest(range(n)) AS i FROM t),
f AS MATERIALIZED (SELECT * FROM w QUALIFY count(*) OVER (PARTITION BY r, w) >= 4),
e AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM f x JOIN f y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
k AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM k GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
u AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM s GROUP BY r, start, length),
b AS (
  SELECT r, count(*) AS n_runs, first(struct_pack(s := start, n := length, q := period) ORDER BY length DESC, start, period) AS top,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM u GROUP BY r),
c AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS kept FROM w
  WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.r = w.r AND w.i >= u.start + u.period AND w.i < u.start + u.length) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.n::BIGINT AS length, top.q::BIGINT AS period,
  (1000 * top.n // top.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b ON b.r = d.r LEFT JOIN c ON c.r = d.r
"""
