"""DuckDB SQL for the results of the training-data queries, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES["op1_decontamination"] = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT rid, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM doc, size, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hit AS (SELECT dw.rid, dw.i, dw.size, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_CANONICAL = r"""(
  WITH a AS (SELECT regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest),
  k AS (SELECT rest, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda k: k <> ''
    AND lower(split_part(k, '=', 1)) NOT IN ('fbclid', 'gclid', 'ref', 'utm_campaign', 'utm_content', 'utm_medium',
    'utm_source', 'utm_term'))) AS keys FROM a)
  SELECT regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''),
      '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(keys) > 0 THEN '?' || array_to_string(keys, '&') ELSE '' END FROM k)"""

ORACLES["op4_revisits"] = f"""
WITH visit AS (
  SELECT page_id, v, url AS given, html, 1700000000 + page_id % 1000 * 60 AS day FROM pages, unnest([0, 1, 2]) AS t(v)
  WHERE NOT (v = 0 AND page_id % 7 = 0)),
rec AS (
  SELECT page_id * 4 + v AS record_id, CASE WHEN v = 1 THEN given || '#again' ELSE given END AS url,
    day + CASE v WHEN 0 THEN 0 WHEN 1 THEN 3000 ELSE 32400 END AS ts, v,
    CASE v WHEN 0 THEN '"' || md5(html) || '"'
      WHEN 1 THEN CASE WHEN page_id % 3 < 2 THEN 'W/"' || md5(html) || '"' ELSE '"other"' END END AS etag,
    CASE v WHEN 0 THEN 'day ' || (page_id % 28 + 1)
      WHEN 2 THEN CASE WHEN page_id % 2 = 1 THEN 'day ' || (page_id % 28 + 1) ELSE 'day 0' END END AS modified,
    CASE v WHEN 0 THEN CAST(strlen(html) AS VARCHAR) WHEN 1 THEN '0' END AS size,
    CASE v WHEN 0 THEN 'max-age=60' WHEN 1 THEN 'no-cache' END AS cache, CASE v WHEN 2 THEN '9' END AS age
  FROM visit),
c AS (SELECT *, {_CANONICAL} AS canonical_url FROM rec),
near AS (
  SELECT r.*, arg_max(f, (f.ts, f.record_id)) AS f
  FROM c r LEFT JOIN c f ON f.v = 0 AND r.canonical_url = f.canonical_url AND f.ts < r.ts
  WHERE r.v > 0 GROUP BY ALL),
said AS (
  SELECT *, CASE WHEN f.record_id IS NULL THEN 'no_earlier_response'
    WHEN etag IS NOT NULL AND f.etag IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f.etag, '^W/', '') THEN 'resolved' ELSE 'validator_mismatch' END
    WHEN modified IS NOT NULL AND f.modified IS NOT NULL THEN
      CASE WHEN modified = f.modified THEN 'resolved' ELSE 'validator_mismatch' END
    ELSE 'no_validator' END AS resolution FROM near),
merged AS (
  SELECT *, resolution = 'resolved' AS ok FROM said)
SELECT record_id, canonical_url, ts, f.record_id AS response_id, f.ts AS response_ts, resolution,
  concat_ws('; ', 'age=' || age, 'cache-control=' || CASE WHEN ok THEN coalesce(cache, f.cache) ELSE cache END,
    'content-length=' || CASE WHEN ok THEN f.size ELSE size END,
    'etag=' || CASE WHEN ok THEN coalesce(etag, f.etag) ELSE etag END,
    'last-modified=' || CASE WHEN ok THEN coalesce(modified, f.modified) ELSE modified END) AS headers
FROM merged
"""

ORACLES["op5_preference"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(turn) AS cut, arg_max(text, turn) AS text FROM t WHERE role = 'assistant' GROUP BY conv_id),
side AS (
  SELECT 'chosen' AS side, t.* FROM t SEMI JOIN last USING (conv_id)
  UNION ALL SELECT 'rejected', t.* FROM t JOIN last USING (conv_id) WHERE turn < cut
  UNION ALL SELECT 'rejected', a.conv_id, a.cut, 'assistant', b.text FROM last a JOIN last b ON b.conv_id = a.conv_id + 1),
fork AS (
  SELECT conv_id, min(CASE WHEN a.role = b.role AND a.text = b.text THEN NULL ELSE turn END) AS fork
  FROM (SELECT * FROM side WHERE side = 'chosen') a FULL JOIN (SELECT * FROM side WHERE side = 'rejected') b USING (conv_id, turn)
  GROUP BY conv_id HAVING count(a.side) > 0 AND count(b.side) > 0),
piece AS (
  SELECT side.conv_id, CASE WHEN turn < coalesce(fork, turn + 1) THEN 'prompt' ELSE side END AS part, turn, role,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece,
    length(role) + 13 AS head, length(text) + 10 AS body
  FROM side JOIN fork USING (conv_id) WHERE side = 'chosen' OR turn >= coalesce(fork, turn + 1)),
placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, part ORDER BY turn) - length(piece) AS pos FROM piece),
part AS (
  SELECT conv_id, part, string_agg(piece, '' ORDER BY turn) AS whole, count(*) AS n,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN (pos + head) || '-' || (pos + head + body) END, ',' ORDER BY turn), '') AS spans
  FROM placed GROUP BY conv_id, part)
SELECT f.conv_id, coalesce(p.n, 0) AS n_prefix, sha256(coalesce(p.whole, '')) AS prompt_sha256,
  sha256(coalesce(c.whole, '')) AS chosen_sha256, sha256(coalesce(r.whole, '')) AS rejected_sha256,
  coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM fork f LEFT JOIN part p ON p.conv_id = f.conv_id AND p.part = 'prompt'
LEFT JOIN part c ON c.conv_id = f.conv_id AND c.part = 'chosen'
LEFT JOIN part r ON r.conv_id = f.conv_id AND r.part = 'rejected'
"""

ORACLES["op7_jaccard"] = """
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT u, v FROM pair JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT a, v FROM reach JOIN link ON b = u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id, coalesce(l.n_links, 0) AS n_links
FROM doc d LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
LEFT JOIN (SELECT u AS doc_id, count(*) AS n_links FROM link GROUP BY u) l USING (doc_id)
"""

# Checksums byte by byte: the table of the reflected polynomial, then a fold over the bytes of the text.
_CRC_TABLE = "CAST(i AS BIGINT)"
for _ in range(8):
    _CRC_TABLE = f"(SELECT xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) FROM (SELECT {_CRC_TABLE} AS c))"

ORACLES["op9_sharding"] = f"""
WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, {_CRC_TABLE} AS v FROM range(256) r(i))),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
    list_transform(regexp_extract_all(lower(hex(encode(coalesce(text, '')))), '..'), lambda h:
      CAST(16 * (instr('0123456789abcdef', h[1]) - 1) + instr('0123456789abcdef', h[2]) - 1 AS BIGINT)) AS bytes,
    md5('shards-1' || coalesce('|' || CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
summed AS (
  SELECT doc.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, b: xor(c >> 8, t[CAST(xor(c % 256, b) AS BIGINT) + 1])), 4294967295) AS text_crc32 FROM doc, crc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY place, doc_id, text_crc32, size) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS of_source FROM summed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + CAST(CAST('0x' || substr(md5('shards-1|source|' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE) / CAST(of_source AS DOUBLE), source NULLS FIRST, place, doc_id,
    text_crc32, size) - 1 AS pos, count(*) OVER () AS n FROM ranked),
cut AS (SELECT *, CAST(pos * 24 // n AS INT) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, CAST(pos - (shard * n + 23) // 24 AS BIGINT) AS slot,
  CAST(NULL AS INT) AS grown_shard FROM cut
"""

# The pages of these tables keep their text in one article element, which a pattern finds as well as a density does.
ORACLES["op6_extraction"] = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
t AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'),
    '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
