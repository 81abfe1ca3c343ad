"""DuckDB SQL that yields the same rows as the queries, written from the contracts."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS g
  FROM w
), e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (len(x.g) + len(y.g) - shared)
), both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM s
  UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c ON c.a = s.doc_id
"""

QUALITY = r"""
WITH w AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), g AS (
  SELECT doc_id, i, words[i:i + 2] AS g FROM w, unnest(range(1, greatest(len(words) - 1, 1))) AS t(i) WHERE len(words) >= 3
), twice AS (SELECT doc_id, g FROM g GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM g JOIN twice USING (doc_id, g), unnest([0, 1, 2]) AS t(k) GROUP BY 1
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w
), m AS (
  SELECT w.doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)
), f AS (
  SELECT *, CAST(n_words < 50 AS INT) AS f1, CAST(100 * n_repeat_words > 50 * n_words AS INT) AS f2,
    CAST(10 * n_symbols > 3 * n_words AS INT) AS f3, CAST(10 * n_dup_lines > n_words AS INT) AS f4 FROM m
), h AS (
  SELECT host, count(*) AS n, [sum(f1), sum(f2), sum(f3), sum(f4)] AS fails FROM f WHERE host IS NOT NULL GROUP BY 1
), r AS (SELECT host, n, k, CAST(fails[k] AS DOUBLE) AS bad FROM h, unnest([1, 2, 3, 4]) AS t(k)),
prior AS (SELECT k, avg(bad / n) AS mu, var_pop(bad / n) AS v, greatest(1.0, avg(n)) AS most FROM r GROUP BY 1),
strength AS (
  SELECT k, mu, CASE WHEN v > 0 THEN least(most, greatest(1.0, mu * (1 - mu) / v - 1)) ELSE most END AS s FROM prior
), verdict AS (
  SELECT host, max((bad + mu * s) / (n + s)) <= 0.5 AS passed FROM r JOIN strength USING (k) GROUP BY 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 + f2 > 0 AS base_failed,
  f1 + f2 = 0 AND coalesce(passed, true) AS kept, coalesce(passed, true) AS host_passed
FROM f LEFT JOIN verdict USING (host)
"""

OVERLAPS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), dw AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS p FROM d),
iw AS (SELECT item_id, len(words) AS size, unnest(words) AS w, unnest(range(len(words))) AS p FROM i WHERE len(words) >= 5),
m AS (
  SELECT doc_id, item_id, size, dw.p - iw.p AS shift, list(iw.p) AS ps FROM dw JOIN iw USING (w)
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= least(size, 10)
), best AS (
  SELECT doc_id, item_id, size, CASE WHEN size < 12 THEN len(ps) ELSE list_max(list_transform(
    range(size - 11), lambda s: len(list_filter(ps, lambda p: p >= s AND p < s + 12)))) END AS matched FROM m
)
SELECT doc_id, item_id, CAST(max(matched) AS BIGINT) AS matched FROM best
WHERE matched >= CASE WHEN size < 12 THEN size ELSE 10 END GROUP BY 1, 2
"""

LOSS_DIFFERENCE = r"""
WITH d AS (
  SELECT doc_id, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS target, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), t AS (SELECT doc_id, target, unnest(words) AS w, unnest(range(len(words))) AS p FROM d),
v AS (SELECT w FROM t GROUP BY w ORDER BY count(*) DESC, w LIMIT 1022),
n AS (SELECT doc_id, target, p, CASE WHEN v.w IS NULL THEN 'unknown' ELSE 'word ' || v.w END AS w FROM t LEFT JOIN v USING (w)),
b AS (SELECT doc_id, target, w, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY p), 'boundary') AS c FROM n),
pairs AS (SELECT c, w, count(*) AS nb, count(*) FILTER (WHERE target) AS nt FROM b GROUP BY 1, 2),
cs AS (SELECT c, sum(nb) AS cb, sum(nt) AS ct FROM pairs GROUP BY 1),
ws AS (SELECT w, sum(nb) AS wb, sum(nt) AS wt FROM pairs GROUP BY 1),
z AS (SELECT sum(nb) AS zb, sum(nt) AS zt FROM pairs),
x AS (
  SELECT c, w,
    -ln(0.7 * CASE WHEN ct > 0 THEN nt / ct WHEN zt > 0 THEN wt / zt ELSE 0 END + 0.25 * CASE WHEN zt > 0 THEN wt / zt ELSE 0 END + 0.05 / 1023)
    + ln(0.7 * nb / cb + 0.25 * wb / zb + 0.05 / 1023) AS x
  FROM pairs JOIN cs USING (c) JOIN ws USING (w) CROSS JOIN z
), s AS (SELECT doc_id, count(*) AS n, avg(x) AS x FROM b JOIN x USING (c, w) GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_tokens, round(coalesce(x, 0.0), 6) AS difference
FROM documents LEFT JOIN s USING (doc_id)
"""

LOSS_DIFFERENCE_EVERY_WORD = r"""
WITH d AS (
  SELECT doc_id, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS target, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), t AS (SELECT doc_id, target, 'word ' || unnest(words) AS w, unnest(range(len(words))) AS p FROM d),
b AS (SELECT doc_id, target, w, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY p), 'boundary') AS c FROM t),
pairs AS (SELECT c, w, count(*) AS nb, count(*) FILTER (WHERE target) AS nt FROM b GROUP BY 1, 2),
cs AS (SELECT c, sum(nb) AS cb, sum(nt) AS ct FROM pairs GROUP BY 1),
ws AS (SELECT w, sum(nb) AS wb, sum(nt) AS wt FROM pairs GROUP BY 1),
z AS (SELECT sum(wb) AS zb, sum(wt) AS zt, count(*) AS v FROM ws),
x AS (
  SELECT c, w,
    -ln(0.7 * CASE WHEN ct > 0 THEN nt / ct WHEN zt > 0 THEN wt / zt ELSE 0 END + 0.25 * CASE WHEN zt > 0 THEN wt / zt ELSE 0 END + 0.05 / v)
    + ln(0.7 * nb / cb + 0.25 * wb / zb + 0.05 / v) AS x
  FROM pairs JOIN cs USING (c) JOIN ws USING (w) CROSS JOIN z
), s AS (SELECT doc_id, count(*) AS n, avg(x) AS x FROM b JOIN x USING (c, w) GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_tokens, round(coalesce(x, 0.0), 6) AS difference
FROM documents LEFT JOIN s USING (doc_id)
"""

PREFERENCES = r"""
WITH c AS (SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
ends AS (SELECT pair_id, max(turn) AS last FROM c WHERE role = 'assistant' GROUP BY 1),
reply AS (SELECT pair_id - 1 AS pair_id, text AS other FROM c JOIN ends USING (pair_id) WHERE turn = last),
g AS (SELECT pair_id, turn, role, text FROM c JOIN ends USING (pair_id) WHERE turn <= last),
b AS (
  SELECT pair_id, turn, role, CASE WHEN turn = last THEN other ELSE text END AS text
  FROM c JOIN ends USING (pair_id) LEFT JOIN reply USING (pair_id) WHERE turn < last OR turn = last AND other IS NOT NULL
), d AS (
  SELECT pair_id, min(turn) FILTER (WHERE g.role IS DISTINCT FROM b.role OR g.text IS DISTINCT FROM b.text) AS differs
  FROM g FULL JOIN b USING (pair_id, turn) GROUP BY 1
), parts AS (
  SELECT pair_id, turn, CASE WHEN differs IS NULL OR turn < differs THEN 'p' ELSE 'g' END AS part, role, text FROM g JOIN d USING (pair_id)
  UNION ALL SELECT pair_id, turn, 'b', role, text FROM b JOIN d USING (pair_id) WHERE turn >= differs
), r AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece FROM parts
), o AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY pair_id, part ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r
), a AS (
  SELECT pair_id, part, count(*) AS n, string_agg(piece, '' ORDER BY turn) AS text, coalesce(string_agg(
    CAST(before + length(role) + 5 AS VARCHAR) || ':' || CAST(before + length(piece) - 1 AS VARCHAR), ',' ORDER BY turn)
    FILTER (WHERE role = 'assistant'), '') AS mask FROM o GROUP BY 1, 2
)
SELECT d.pair_id, CAST(coalesce(max(n) FILTER (WHERE part = 'p'), 0) AS BIGINT) AS n_prompt_turns,
  coalesce(max(text) FILTER (WHERE part = 'p'), '') AS prompt, coalesce(max(text) FILTER (WHERE part = 'g'), '') AS chosen,
  coalesce(max(text) FILTER (WHERE part = 'b'), '') AS rejected, coalesce(max(mask) FILTER (WHERE part = 'g'), '') AS chosen_mask,
  coalesce(max(mask) FILTER (WHERE part = 'b'), '') AS rejected_mask
FROM d LEFT JOIN a USING (pair_id) GROUP BY 1
"""

DIVERGENCES = r"""
WITH d AS (
  SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    row_number() OVER () AS rid
  FROM documents
), t AS (
  SELECT lang, source, rid,
    translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), occ AS (SELECT lang, source, term, count(*) AS cnt FROM t GROUP BY ALL),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(o.cnt, 0) AS cnt
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN occ o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), gn AS (SELECT lang, source, sum(cnt) AS n FROM grid GROUP BY ALL),
gp AS (
  SELECT grid.lang, grid.source, grid.term, grid.cnt,
    1 + (1000000000 * (grid.cnt + 2)) // (gn.n + 2 * v.v) AS p
  FROM grid JOIN gn USING (lang, source) JOIN v USING (lang)
), lc AS (SELECT lang, term, sum(cnt) AS cnt FROM grid GROUP BY ALL),
ln AS (SELECT lang, sum(cnt) AS n FROM lc GROUP BY lang),
lq AS (
  SELECT lc.lang, lc.term, 1 + (1000000000 * (lc.cnt + 2)) // (ln.n + 2 * v.v) AS q
  FROM lc JOIN ln USING (lang) JOIN v USING (lang)
), pair_sums AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM gp x JOIN gp y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT gp.lang, gp.source, 'term' AS part, gp.term AS item,
    CAST((gp.p - lq.q) * (gp.p - lq.q) // (gp.p + lq.q) AS BIGINT) AS value
  FROM gp JOIN lq USING (lang, term)
  WHERE gp.cnt > 0 AND gp.p > lq.q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
