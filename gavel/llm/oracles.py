"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP9 = r"""
WITH rules(kind, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
hit AS (
  SELECT n, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule,
    arg_max(kind, length(r.host) + length(r.path)) AS kind
  FROM p JOIN rules r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(kind, 'allow') AS verdict FROM p LEFT JOIN hit USING (n)
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)),
hit AS (
  SELECT doc_id, list(i) AS starts FROM (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY words) AS first FROM win) WHERE first < doc_id GROUP BY doc_id),
j AS (
  SELECT d.doc_id, k, w[k] AS word, coalesce(list_bool_or(list_transform(starts, lambda s: s <= k AND k <= s + 12)), false) AS gone
  FROM d LEFT JOIN hit USING (doc_id), unnest(generate_series(1, len(w))) AS t(k))
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(g.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept FROM j GROUP BY doc_id) g
USING (doc_id)
"""

OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 4 THEN list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END)) AS shingle
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 80 * (nx.n + ny.n - common)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)
"""

OP11 = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM p, unnest([1, 2, 3, 4]) AS s(m), unnest(generate_series(1, len(w) - m + 1)) AS u(i)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
e AS MATERIALIZED (SELECT lang || chr(9) || phrase AS id, a FROM f WHERE a >= 30),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 30),
k AS (
  SELECT lang, phrase, a, k, lang || chr(9) || array_to_string(w[1:k], ' ') AS x, lang || chr(9) || array_to_string(w[k + 1:], ' ') AS y
  FROM c, unnest(generate_series(1, m - 1)) AS u(k)),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.a AS l, r.a AS r, ((2000000::HUGEINT * k.a) // (l.a::HUGEINT + r.a))::BIGINT AS score
  FROM k JOIN e l ON l.id = k.x JOIN e r ON r.id = k.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (
  SELECT lang, array_to_string(w[i:i + h - 1], ' ') AS phrase, max(a) AS longer
  FROM c, unnest([2, 3]) AS v(h), unnest(generate_series(1, m - h + 1)) AS u(i) WHERE h < m GROUP BY ALL),
z AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN o USING (lang, phrase) WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id AS c, list(json_array(role, text)::VARCHAR ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS s
  FROM src GROUP BY conv_id),
h AS (
  SELECT c, s, (xor(4294967295, list_reduce(
    list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda crc, d: list_reduce(
      [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, d)),
    4294967295::BIGINT)) % 4)::BIGINT AS h FROM o),
r AS (
  SELECT h.c, coalesce(b.s[1:h.h], []) || h.s[h.h + 1:] AS s FROM h LEFT JOIN o b ON b.c = h.c - h.c % 20),
m AS (
  SELECT c, d, sha256(s[1:d]::JSON::VARCHAR) AS node, sha256(s[1:d - 1]::JSON::VARCHAR) AS parent, s[1:d] AS path, d = len(s) AS ends
  FROM r, unnest(generate_series(0, len(s))) AS t(d)),
n AS (
  SELECT d, node, any_value(parent) AS parent, any_value(path) AS path, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids
  FROM m GROUP BY d, node),
k AS (SELECT parent, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
v AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, p.conv_id AS parent_conv_id,
    CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.path[n.d]::JSON ->> 1, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN k ON k.parent = n.node AND k.d = n.d LEFT JOIN n p ON n.d > 0 AND p.node = n.parent AND p.d = n.d - 1),
a AS (
  SELECT u.d, u.anc AS node, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves FROM (
    SELECT i AS d, sha256(path[1:i]::JSON::VARCHAR) AS anc, saved, n_children = 0 AS leaf
    FROM v, unnest(generate_series(0, d)) AS t(i)) u GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, parent_conv_id, n_convs, n_children, leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256
FROM v JOIN a ON a.node = v.node AND a.d = v.d
"""

STATEMENTS: dict[str, str] = {"op2_near_duplicates": OP2, "op6_substrings": OP6, "op9_urls": OP9, "op11_collocations": OP11, "op13_prefix_trie": OP13}
