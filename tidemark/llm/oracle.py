"""DuckDB SQL for the training-data queries that SQL can express over whole tables."""

_WORDS = "string_split_regex(trim(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), ' ')"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (h)
"""

ORACLE_SQL["op10_leaks"] = f"""
WITH dw AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
iw AS (SELECT DISTINCT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
ish AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' ')))) AS s
  FROM iw),
cnt AS (SELECT item_id, count(*) AS n FROM ish GROUP BY item_id),
dsh AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM dw),
hit AS (SELECT doc_id, item_id, count(*) AS shared FROM dsh JOIN ish USING (s) WHERE s <> '' GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS item_shingles, shared AS shared_shingles, shared / n AS containment
FROM hit JOIN cnt USING (item_id) WHERE shared >= 0.8 * n
"""

ORACLE_SQL["op2_ngram_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i+2], ' '))) AS s FROM w),
own AS (SELECT doc_id, s FROM sh WHERE s <> ''),
n AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM own a JOIN own b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT y, root FROM reach JOIN edges ON x = node)
SELECT node AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node
"""

# the given pages mark their article and know five character references
ORACLE_SQL["op11_host_suffixes"] = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, string_split_regex(regexp_replace(regexp_replace(body, '<br>', ' ', 'g'), '</?(b|i|em|strong|a|span)>', '', 'g'), '<[^>]*>') AS parts FROM a),
c AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM b),
d AS (SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""

# crc32(c) % 4, bit by bit over the decimal digits; 3988292384 is the reversed polynomial
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
  lambda ch: list_transform(range(0, 8), lambda i: (ascii(ch) >> i::INT) & 1)))),
  lambda a, b: xor(a >> 1, CASE WHEN xor(a & 1, b) = 1 THEN 3988292384 ELSE 0 END))"""

ORACLE_SQL["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id AS c, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'s': s, 'w': w}} ORDER BY turn NULLS FIRST, s) AS ts FROM t GROUP BY c),
hs AS (SELECT c, ts, (xor({_CRC}, 4294967295) % 4)::INT AS h FROM own),
full_ AS (SELECT hs.c, list_concat(coalesce(b.ts, [])[1:h], hs.ts[h + 1:]) AS ts FROM hs LEFT JOIN own b ON b.c = hs.c - hs.c % 20),
keys AS (SELECT c, ts, list_transform(range(0, len(ts) + 1), lambda d: sha256(array_to_string(list_transform(ts[1:d], lambda x: x.s), ''))) AS k FROM full_),
m AS (SELECT c, unnest(range(0, len(ts) + 1)) AS d, unnest(k) AS key, len(ts) AS n, ts FROM keys),
node AS (SELECT key, d, min(c) AS c, count(*) AS n_convs, coalesce(sha256(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d)), sha256('')) AS ends,
    any_value(CASE WHEN d > 0 THEN ts[d].w ELSE 0 END) AS w FROM m GROUP BY key, d),
up AS (SELECT node.*, m.key AS anc, m.d AS anc_d FROM node JOIN m ON m.c = node.c AND m.d <= node.d),
kids AS (SELECT anc AS key, count(*) AS n_children FROM up WHERE anc_d = d - 1 GROUP BY anc),
sums AS (SELECT anc AS key, sum((n_convs - 1) * w)::BIGINT AS saved, count(*) FILTER (up.key NOT IN (SELECT key FROM kids)) AS n_leaves FROM up GROUP BY anc),
par AS (SELECT up.key, p.c AS parent FROM up JOIN node p ON p.key = up.anc WHERE anc_d = up.d - 1)
SELECT node.c AS conv_id, node.d AS depth, par.parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved AS saved_tokens, ends AS ends_sha256
FROM node JOIN sums USING (key) LEFT JOIN kids USING (key) LEFT JOIN par USING (key)
"""

ORACLE_SQL["op13_fill_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::UBIGINT::BIGINT) AS h FROM d),
c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""
