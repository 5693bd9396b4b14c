"""DuckDB twins of the queries that SQL can express, written from their definitions."""
from __future__ import annotations

_ESCAPED = "length({0}) * 2 - length(replace(replace(replace({0}, '\\', ''), '<', ''), '>', ''))"

OP5 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS probe(i, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<turn:></turn>') + 1 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

OP7 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
grams AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM grams),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)"""

_LIKE = "lower(trim(regexp_replace({0}, '[\\x20\\x09-\\x0D]+', ' ', 'g')))"

OP10 = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
                  string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
win AS (SELECT doc_id, i, ws[i:i + 7] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
reps AS (SELECT doc_id, sum(x)::BIGINT AS n
         FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS x FROM again) GROUP BY doc_id),
line AS (SELECT doc_id, source, text, unnest(ls) AS line FROM w),
dups AS (SELECT doc_id, (count(line) - count(DISTINCT line))::BIGINT AS n FROM line
         WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
like_line AS (SELECT doc_id, source, text, length(line) AS chars, {_LIKE.format('line')} AS l FROM line),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM w GROUP BY source),
above AS (SELECT source, l FROM like_line JOIN hosts USING (source) WHERE l <> '' GROUP BY source, l, texts
          HAVING count(DISTINCT text) >= 20 AND count(DISTINCT text) > 0.10 * texts),
gone AS (SELECT doc_id, sum(chars)::BIGINT AS n FROM like_line SEMI JOIN above USING (source, l) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, length(w.text) AS chars, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(reps.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_chars
  FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN reps USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_removed_chars,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND chars - n_removed_chars >= 0.30 * chars AS kept
FROM m"""

# crc32 (polynomial 0xEDB88320, reflected) of a decimal number's digits, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]),
    lambda s, i: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""

OP11 = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, ({_CRC32.format('c')} % 4)::BIGINT AS h FROM t GROUP BY c),
k AS (SELECT n.c, n.h, n.n, least(n.h, coalesce(b.n, 0)) AS taken FROM n LEFT JOIN n AS b ON b.c = n.c - n.c % 20),
r AS (
  SELECT k.c, pos AS d, role, text FROM k JOIN t ON t.c = k.c - k.c % 20 AND pos <= taken
  UNION ALL
  SELECT k.c, pos - h + taken, role, text FROM k JOIN t USING (c) WHERE pos > h),
s AS MATERIALIZED (
  SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS node
  FROM r
  UNION ALL SELECT c, 0, 0, 'root' FROM k),
p AS MATERIALIZED (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, lead(node) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends FROM s),
nodes AS MATERIALIZED (
  SELECT node, d, min(c) AS conv_id, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY node, d),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sub AS (
  SELECT p.node, sum((NOT EXISTS (SELECT 1 FROM kids WHERE kids.node = m.node))::INT)::BIGINT AS n_leaves, sum(m.saved)::BIGINT AS saved_tokens
  FROM nodes AS m JOIN p ON p.c = m.conv_id AND p.d <= m.d GROUP BY p.node)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children,
       n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sub USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes AS up ON up.node = nodes.parent"""

_NEAREST = """a{n} AS MATERIALIZED (
  SELECT vec_id, q, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, v.vec_id, v.q, m.c, list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - m.q[i]) * (v.q[i] - m.q[i])))::BIGINT AS d
    FROM v, m{n} AS m)
  GROUP BY r, vec_id, q)"""
_MOVED = """m{n} AS MATERIALIZED (
  SELECT c, coalesce(moved.q, m{p}.q) AS q FROM m{p} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q FROM (
      SELECT c, i, sum(q[i]) AS s, count(*) AS n FROM a{p}, range(1, 65) AS pos(i) GROUP BY c, i)
    GROUP BY c) AS moved USING (c))"""

OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, q FROM v QUALIFY c < 16),
{_NEAREST.format(n=0)}, {_MOVED.format(n=1, p=0)},
{_NEAREST.format(n=1)}, {_MOVED.format(n=2, p=1)},
{_NEAREST.format(n=2)}, {_MOVED.format(n=3, p=2)},
{_NEAREST.format(n=3)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m3.q, ',')) AS centroid_sha256
FROM a3 JOIN m3 USING (c)"""

SQL = {"op11_conversation_trie": OP11, "op12_centroid_clustering": OP12, "op5_chat_formatting": OP5, "op7_minhash_near_dedup": OP7, "op10_quality_rules": OP10}
