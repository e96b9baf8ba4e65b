"""The operators' results as DuckDB SQL, where SQL can express them."""

SQL = {
    "op5_substrings": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, h FROM d),
v AS MATERIALIZED (SELECT doc_id, b, substr(h, 2 * b + 1, 298) AS y FROM (SELECT doc_id, h, unnest(range(0, greatest(n_bytes - 49, 0), 100)) AS b FROM s)),
w AS (SELECT doc_id, b + k AS k, substr(y, 2 * k + 1, 100) AS x FROM (SELECT doc_id, b, y, unnest(range(greatest(len(y) // 2 - 49, 0))) AS k FROM v)),
f AS (SELECT x, min(doc_id) AS first FROM w GROUP BY x),
g AS (SELECT w.doc_id, k FROM w JOIN f USING (x) WHERE first < w.doc_id),
m AS (SELECT doc_id, k, CASE WHEN k <= 50 + lag(k) OVER (PARTITION BY doc_id ORDER BY k) THEN 0 ELSE 1 END AS new FROM g),
i AS (SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS island FROM m),
r AS (SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM i GROUP BY doc_id, island),
n AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY 1),
c AS (SELECT doc_id, a AS pos, b AS nxt FROM r UNION ALL SELECT doc_id, 0, 0 FROM s),
o AS (SELECT doc_id, nxt AS a, lead(pos) OVER (PARTITION BY doc_id ORDER BY nxt, pos) AS b FROM c),
p AS (SELECT o.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n_bytes) - a)), '' ORDER BY a) AS kept FROM o JOIN s USING (doc_id) GROUP BY 1)
SELECT s.doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM s JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op7_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item_id, k, least(len(w), 13) AS n, array_to_string(w[k : k + least(len(w), 13) - 1], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(len(w) - 11, 2))) AS k FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) + 2 - n)) AS k FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, p.k, p.n, p.k - q.k AS diagonal FROM p JOIN q USING (n, x)),
t AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM h) GROUP BY 1),
j AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1),
l AS (SELECT doc_id, max(len) AS longest FROM (SELECT doc_id, count(*) + max(n) - 1 AS len FROM
      (SELECT *, k - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k) AS chain FROM h) GROUP BY doc_id, item_id, diagonal, chain) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(longest, 0) AS longest
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN j USING (doc_id) LEFT JOIN l USING (doc_id)""",
    "op8_jaccard": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
      UNION SELECT x.doc_id, y.doc_id FROM d x JOIN d y USING (text) WHERE x.doc_id <> y.doc_id),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
m AS (SELECT node, min(root) AS class_id FROM r GROUP BY 1),
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)
SELECT d.doc_id, class_id, min(d.doc_id) OVER (PARTITION BY text) AS copy_of, coalesce(n_links, 0) AS n_links
FROM d JOIN m ON m.node = d.doc_id LEFT JOIN k ON k.a = d.doc_id""",
    "op6_lines": r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS idx
      FROM (SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS x FROM s) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
r AS (SELECT *, lead(x) OVER w AS x2, lead(line) OVER w + 1 AS b2 FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
p AS (SELECT doc_id, idx, line AS a, line + 1 AS b, x AS one, NULL AS two FROM r WHERE regexp_matches(x, '^\s*(?:\S+\s+){4}\S')
      UNION ALL SELECT doc_id, idx, line, b2, x, x2 FROM r WHERE x2 IS NOT NULL),
f AS (SELECT *, min((doc_id, a)) OVER (PARTITION BY one, two) AS first FROM p),
g AS (SELECT * FROM f WHERE (doc_id, a) <> first),
d AS (SELECT DISTINCT l.doc_id, line FROM l JOIN g ON g.doc_id = l.doc_id AND line >= a AND line < b),
h AS (SELECT DISTINCT u.doc_id, u.line FROM (SELECT doc_id, unnest(range(len(parts))) AS line FROM s) u JOIN g ON g.doc_id = u.doc_id AND u.line >= a AND u.line < b),
q AS (SELECT v.doc_id, v.idx, e.doc_id AS doc2, e.idx - v.idx AS diagonal FROM p v JOIN p e ON v.one = e.one AND v.two = e.two WHERE (e.doc_id, e.idx) < (v.doc_id, v.idx)),
c AS (SELECT *, idx - row_number() OVER (PARTITION BY doc_id, doc2, diagonal ORDER BY idx) AS chain FROM q),
m AS (SELECT doc_id, idx, max(upto) + 2 - idx AS size FROM (SELECT doc_id, idx, max(idx) OVER (PARTITION BY doc_id, doc2, diagonal, chain) AS upto FROM c) GROUP BY 1, 2
      UNION ALL SELECT doc_id, idx, 1 FROM g WHERE two IS NULL),
z AS (SELECT doc_id, idx, max(size) AS size FROM m GROUP BY 1, 2),
k AS (SELECT doc_id, count(*) AS n_runs, max(size) AS longest_run FROM (SELECT *, max(idx + size) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM z)
      WHERE before IS NULL OR idx + size > before GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM d GROUP BY 1),
e AS (SELECT u.doc_id, string_agg(u.x, chr(10) ORDER BY u.line) AS kept FROM (SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS x FROM s) u ANTI JOIN h USING (doc_id, line) GROUP BY 1)
SELECT t.doc_id, coalesce((SELECT count(*) FROM l WHERE l.doc_id = t.doc_id), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       coalesce(longest_run, 0) AS longest_run, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents t LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)""",
    "op10_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, t.turn, t.role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role))),
d AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS escaped
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) + CASE WHEN before = role THEN 10 ELSE 13 + length(role) END + CASE WHEN after = role THEN 0 ELSE 11 END) AS BIGINT) AS formatted_chars
FROM d GROUP BY conv_id""",
    "op11_sessions": r"""
WITH RECURSIVE c AS (SELECT click_id, epoch_us(ts) AS us, epoch_us(arrived_at) AS came, client_id, kind, value FROM clicks
  WHERE click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY came NULLS FIRST, us, client_id, kind NULLS FIRST, value NULLS FIRST) = 1),
t AS (SELECT *, coalesce(value >= 60 AND NOT isnan(value) AND kind IN ('purchase', 'signup'), false) AS final, row_number() OVER (PARTITION BY client_id ORDER BY us, click_id) AS rn
      FROM c WHERE coalesce(came - us <= 900000000, true)),
h AS (SELECT *, CASE WHEN rn = 1 THEN 'first' WHEN lag(final) OVER w THEN 'end' WHEN us - lag(us) OVER w >= 900000000 THEN 'gap' END AS hard FROM t WINDOW w AS (PARTITION BY client_id ORDER BY rn)),
g AS MATERIALIZED (SELECT *, count(hard) OVER (PARTITION BY client_id ORDER BY rn) AS seg FROM h),
u AS (SELECT client_id, seg, us, min(rn) AS rn FROM g GROUP BY ALL),
j AS MATERIALIZED (SELECT a.client_id, a.rn, b.rn AS nxt FROM (SELECT client_id, seg, rn, us + 3600000000 AS upto FROM g) a ASOF JOIN u b ON a.client_id = b.client_id AND a.seg = b.seg AND a.upto < b.us),
b AS (SELECT client_id, rn FROM g WHERE hard IS NOT NULL UNION ALL SELECT j.client_id, j.nxt FROM b JOIN j ON j.client_id = b.client_id AND j.rn = b.rn),
s AS (SELECT g.*, count(b.rn) OVER (PARTITION BY g.client_id ORDER BY g.rn) AS session, b.rn IS NOT NULL AS begins FROM g LEFT JOIN b ON b.client_id = g.client_id AND b.rn = g.rn),
p AS (SELECT client_id, session, arg_min(click_id, rn) AS session_id, min(us) AS start_us, max(us) AS end_us, count(*) AS n_clicks, arg_max(final, rn) AS final,
        CAST(sum(CASE WHEN isfinite(value) THEN CAST(floor(100 * value + 0.5) AS BIGINT) ELSE 0 END) AS BIGINT) AS value_cents, string_agg(CAST(click_id AS VARCHAR), ',' ORDER BY rn) AS path,
        max(CASE WHEN begins THEN coalesce(hard, 'length') END) AS why FROM s GROUP BY 1, 2),
q AS (SELECT *, lead(start_us) OVER w AS upto, coalesce(lead(why) OVER w, CASE WHEN final THEN 'end' ELSE 'none' END) AS closed_by FROM p WINDOW w AS (PARTITION BY client_id ORDER BY session)),
l AS (SELECT client_id, us FROM c WHERE came - us > 900000000),
n AS (SELECT q.client_id, q.session, count(*) AS n_late FROM q JOIN l ON l.client_id = q.client_id AND l.us >= q.start_us AND (q.upto IS NULL OR l.us < q.upto) GROUP BY 1, 2)
SELECT client_id, session_id, start_us, end_us, n_clicks, coalesce(n_late, 0) AS n_late, value_cents, closed_by, sha256(path) AS path_sha256 FROM q LEFT JOIN n USING (client_id, session)""",
    "op12_secrets": r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, rank, least, grp, rx) AS (VALUES
  ('assign', 0, 8, 2, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 16, 0, 'AKIA[A-Z0-9]+'), ('hex', 2, 32, 0, '[0-9a-f]+'),
  ('identifier', 3, 3, 2, '([Uu][Ss][Ee][Rr][Nn][Aa][Mm][Ee]|[Uu][Ss][Ee][Rr]|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Kk][Ee][Yy]_?[Ii][Dd])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9_.@+-]+)'),
  ('secret', 4, 16, 0, '[A-Za-z0-9+/_-]+'), ('endpoint', 5, 11, 0, 'https?://[A-Za-z0-9._~:/?#@%&=+-]+')),
m AS (SELECT uid, kind, rank, least, grp, rx, text, regexp_extract_all(text, rx) AS hit, string_split_regex(text, rx) AS gap FROM d, rules),
u AS (SELECT * EXCLUDE (hit, gap), unnest(range(len(hit))) AS n, unnest(hit) AS x, unnest(gap[1 : len(hit)]) AS g FROM m WHERE len(hit) > 0),
w AS (SELECT *, CAST(sum(length(g) + length(x)) OVER (PARTITION BY uid, kind ORDER BY n ROWS UNBOUNDED PRECEDING) AS BIGINT) AS b FROM u),
h AS (SELECT uid, kind, rank, b - length(x) AS a, b, x, text FROM w WHERE length(CASE WHEN grp = 2 THEN regexp_extract(x, rx, 2) ELSE x END) >= least),
f AS (SELECT * FROM h WHERE rank < 3),
i AS (SELECT * FROM h WHERE kind = 'identifier' AND NOT EXISTS (SELECT 1 FROM f WHERE f.uid = h.uid AND f.a < h.b AND h.a < f.b)),
e AS (SELECT * FROM h WHERE kind = 'endpoint' AND NOT EXISTS (SELECT 1 FROM f WHERE f.uid = h.uid AND f.a < h.b AND h.a < f.b)),
t AS (SELECT uid, a, b FROM f UNION ALL SELECT uid, a, b FROM i UNION ALL SELECT uid, a, b FROM e),
k AS (SELECT * FROM h WHERE kind = 'secret' AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]')
      AND NOT EXISTS (SELECT 1 FROM t WHERE t.uid = h.uid AND t.a < h.b AND h.a < t.b)),
z AS (SELECT * EXCLUDE (x, text), len(regexp_extract_all(substr(text, 1, a), '\n[\x20\t\r]*\n')) AS scope FROM (FROM f UNION ALL FROM i UNION ALL FROM e UNION ALL FROM k)),
p AS (SELECT l.uid, l.scope, l.rank AS lr, l.a AS la, l.b AS lb, r.rank AS rr, r.a AS ra, r.b AS rb FROM z l JOIN z r ON l.uid = r.uid AND l.scope = r.scope
      WHERE l.rank IN (1, 3) AND r.rank IN (0, 2, 4) AND greatest(l.a, r.a) - least(l.b, r.b) <= 200),
q AS (SELECT p.*, z.a AS ea, z.b AS eb FROM p JOIN z ON z.uid = p.uid AND z.scope = p.scope AND z.rank = 5 AND greatest(z.a, la) - least(z.b, lb) <= 200 AND greatest(z.a, ra) - least(z.b, rb) <= 200),
r AS (SELECT uid, lr AS rank, la AS a, lb AS b FROM p WHERE rr < 3 UNION SELECT uid, rr, ra, rb FROM p WHERE lr < 3 UNION SELECT uid, lr, la, lb FROM q UNION SELECT uid, rr, ra, rb FROM q UNION SELECT uid, 5, ea, eb FROM q),
s AS (SELECT uid, rank, a, b FROM f UNION SELECT * FROM r WHERE rank >= 3),
o AS (SELECT uid, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, s.rank) AS spans, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, s.rank) FILTER (s.rank < 3) AS base,
        count(*) FILTER (s.rank = 0) AS n_assign, count(*) FILTER (s.rank = 1) AS n_access, count(*) FILTER (s.rank = 2) AS n_hex FROM s JOIN rules ON rules.rank = s.rank GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (uid)""",
    "op13_spelling": r"""
WITH RECURSIVE c0 AS (SELECT range AS k, range AS v, 0 AS step FROM range(256) UNION ALL
  SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, step + 1 FROM c0 WHERE step < 8),
c AS (SELECT list(v ORDER BY k) AS codes FROM c0 WHERE step = 8),
r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
      WHERE length(run) >= 5 GROUP BY ALL),
b AS (SELECT *, list_concat([CAST(4294967295 AS BIGINT)], flatten([CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END FOR x IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')])) AS bytes FROM r),
h AS (SELECT doc_id, run, n, 4294967295 - list_reduce(bytes, lambda s, x: xor(s // 256, codes[xor(s % 256, x) + 1])) AS h FROM b, c),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
d AS (SELECT word, n, i, substr(word, 1, i) || '_' || substr(word, i + 2) AS gone FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.gone = b.gone AND a.word <> b.word),
s AS (SELECT DISTINCT word, n, replace(gone, '_', '') AS short FROM d),
e AS (SELECT DISTINCT s.word, s.n, w.word AS near, w.n AS m FROM s JOIN w ON w.word = s.short),
q AS (SELECT word, near, m FROM p UNION ALL SELECT word, near, m FROM e UNION ALL SELECT near, word, n FROM e),
z AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, near)) AS form, max(m) AS form_n FROM q GROUP BY 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM w LEFT JOIN z USING (word)),
g AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, g.root FROM g JOIN f ON f.form = g.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN g USING (word)""",
}
