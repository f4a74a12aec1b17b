"""DuckDB SQL for the dealt operators that SQL can express.

Written from the operators' contracts alone; nothing is imported from the
modules that it checks.
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
  SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex
), five AS (
  SELECT p.page_id, p.h, p.hex, g.first_id,
         list_transform(range(8), lambda i: ('0x' || substr(p.hex, (i * 5 + 1)::BIGINT, 5))::BIGINT) AS v
  FROM p JOIN g USING (hex)
)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
       array_to_string(list_transform(v, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM five
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), lens AS (
  SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)
), m AS (
  SELECT dw.doc_id, s, n, item_id FROM dw JOIN bw USING (g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT r, p, md5(substr(h, 2 * p + 1, 800)) AS m
  FROM (SELECT r, h, unnest(range(0, (length(h) // 2 - 399)::BIGINT)) AS p FROM d WHERE length(h) >= 800)
), twice AS (
  SELECT m FROM s GROUP BY m HAVING count(*) > 1
), hit AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM s SEMI JOIN twice USING (m)
), grp AS (
  SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS g
  FROM hit
), span AS (
  SELECT r, min(p) AS a, max(p) + 400 AS z FROM grp GROUP BY r, g
), gaps AS (
  SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS after,
         row_number() OVER (PARTITION BY r ORDER BY a DESC) AS from_last FROM span
), kept AS (
  SELECT gaps.r, sum(z - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a)
         || max(CASE WHEN from_last = 1 THEN substr(h, 2 * z + 1) ELSE '' END) AS k
  FROM gaps JOIN d ON d.r = gaps.r GROUP BY gaps.r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r
"""

OP7 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT r, doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS m
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)
), least AS (
  SELECT m, min(doc_id) AS first_id FROM s GROUP BY m
), gone AS (
  SELECT DISTINCT r, unnest(range(p, p + 13)) AS q FROM s JOIN least USING (m) WHERE s.doc_id > first_id
), per AS (
  SELECT r, count(*) AS n_removed, list(q) AS qs FROM gone GROUP BY r
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS k
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) AS x ANTI JOIN gone ON gone.r = x.r AND gone.q = x.i
  GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), e AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least(len(w), 3) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * i >= 90 * (a.n + b.n - i)
), edge AS (
  SELECT x, y FROM link UNION SELECT y, x FROM link
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM reach r JOIN edge e ON e.x = r.y
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1, 2
"""

OP12 = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id
), cell AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b
), o AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM l p, l q, l r, l s, l t WHERE (p.b | q.b | r.b | s.b | t.b) = 31
), st AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), per AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN (mask & (before | bit)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (mask & bit) > 0 AND (mask & before) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, st GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM per
"""

OP13 = r"""
WITH o AS (
  SELECT conv_id AS c, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT c, m, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(m, 1, 32)) AS pos FROM o
), tab AS (
  SELECT list_reduce(list_prepend(k::BIGINT, range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v, k
  FROM (SELECT unnest(range(256)) AS k)
), tabs AS (
  SELECT list(v ORDER BY k) AS t FROM tab
), ids AS (
  SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
         lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM p), tabs
), own AS (
  SELECT c, list(m ORDER BY pos) AS ms, list(words ORDER BY pos) AS ws FROM p GROUP BY c
), seq AS (
  SELECT ids.c, CASE WHEN base.c IS NULL THEN own.ms[h + 1:] ELSE list_concat(base.ms[1:h], own.ms[h + 1:]) END AS ms,
         CASE WHEN base.c IS NULL THEN own.ws[h + 1:] ELSE list_concat(base.ws[1:h], own.ws[h + 1:]) END AS ws
  FROM ids JOIN own ON own.c = ids.c LEFT JOIN own base ON base.c = ids.b
), path AS (
  SELECT c, d, len(ms) AS n, sha256(array_to_string(ms[1:d], '')) AS g,
         CASE WHEN d > 0 THEN sha256(array_to_string(ms[1:d - 1], '')) END AS pg, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words
  FROM (SELECT c, ms, ws, unnest(range(0, len(ms) + 1)) AS d FROM seq)
), node AS (
  SELECT g, d, min(pg) AS pg, min(c) AS first_c, count(*) AS n_convs, (count(*) - 1) * max(words) AS worth,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256
  FROM path GROUP BY g, d
), kids AS (
  SELECT pg, d, count(*) AS k FROM node WHERE d > 0 GROUP BY pg, d
), sub AS (
  SELECT path.g, path.d, sum(x.worth) AS saved, sum(CASE WHEN k.k IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM node x LEFT JOIN kids k ON k.pg = x.g AND k.d = x.d + 1 JOIN path ON path.c = x.first_c AND path.d <= x.d
  GROUP BY path.g, path.d
)
SELECT node.first_c AS conv_id, node.d::BIGINT AS depth, up.first_c AS parent_conv_id, node.n_convs::BIGINT AS n_convs,
       coalesce(kids.k, 0)::BIGINT AS n_children, sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN sub ON sub.g = node.g AND sub.d = node.d LEFT JOIN kids ON kids.pg = node.g AND kids.d = node.d + 1
LEFT JOIN node up ON up.g = node.pg AND up.d = node.d - 1
"""
