"""SQL for the operators that SQL can express, on the same tables."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: eight shifts a byte by the reflected polynomial."""
    bit = "list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), {start})"
    step = bit.format(start="xor(crc, byte)")
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda crc, byte: {step}, 4294967295::BIGINT), 4294967295)"


#: Equal 16-word stretches of a text meet on the diagonal of their distance; consecutive ones are a match.
OP11_SQL = f"""
WITH hashed AS (
  SELECT doc_id, {_crc32("doc_id::VARCHAR")} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
sized AS (SELECT *, len(words) AS n, h // 10 AS g FROM hashed),
shaped AS (
  SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM sized),
w AS (
  SELECT doc_id, i, words[(CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END) + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)),
grams AS (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING)) AS gram,
         lead(i, 15) OVER (PARTITION BY doc_id ORDER BY i) AS last
  FROM w),
pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
  WHERE x.last IS NOT NULL AND y.last IS NOT NULL),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 15 + q AS len FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, s, len, min(q) AS q FROM stretches WHERE len >= greatest(24, 3 * q) GROUP BY doc_id, s, len),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id),
best AS (
  SELECT r.* FROM runs r
  WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (
      o.len * r.q > r.len * o.q OR (o.len * r.q = r.len * o.q AND (o.s < r.s OR (o.s = r.s AND o.q < r.q)))))),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.s + r.q AND w.i < r.s + r.len)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       1000 * b.len // b.q AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP12_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (key) GROUP BY doc_id
"""

OP13_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.i, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i >= c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
         md5(string_agg(md5(md5(role) || md5(text)), '') OVER (w ROWS UNBOUNDED PRECEDING)) AS prefix
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
prefixes AS (
  SELECT conv_id, depth, bytes, prefix FROM steps UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefixes GROUP BY depth, prefix),
path AS (
  SELECT p.conv_id, p.depth, n.conv_id AS owner FROM prefixes p JOIN nodes n USING (depth, prefix)),
parents AS (
  SELECT n.*, p.owner AS parent FROM nodes n LEFT JOIN path p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c USING (conv_id, depth)),
totals AS (
  SELECT a.owner AS conv_id, a.depth, sum(CASE WHEN s.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((s.n_convs - 1) * s.bytes) AS saved_tokens
  FROM sized s JOIN path a ON a.conv_id = s.conv_id AND a.depth <= s.depth GROUP BY ALL),
ends AS (
  SELECT p.owner AS conv_id, p.depth, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
  FROM path p JOIN (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id) USING (conv_id, depth) GROUP BY ALL)
SELECT s.conv_id, s.depth, s.parent AS parent_conv_id, s.n_convs, s.n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM sized s JOIN totals t USING (conv_id, depth) LEFT JOIN ends e USING (conv_id, depth)
"""
