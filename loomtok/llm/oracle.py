"""DuckDB SQL of the operators that SQL can express on whole tables."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op6_decontaminate"] = r"""
WITH docs AS (
  SELECT doc_id, rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lens WHERE len(w) >= n)),
hits AS (SELECT rid, windows.n, i, item FROM windows JOIN grams ON windows.gram = grams.gram AND windows.n = grams.n),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""

ORACLE_SQL["op10_line_spread"] = """
WITH docs AS (SELECT *, row_number() OVER () AS rid FROM documents),
lines AS (
  SELECT rid, source, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT rid, source, string_split(text, chr(10)) AS parts FROM docs WHERE text IS NOT NULL)),
wide AS (SELECT trim(line) AS line FROM lines WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 10),
marked AS (SELECT lines.*, wide.line IS NOT NULL AS hit FROM lines LEFT JOIN wide ON trim(lines.line) = wide.line),
texts AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (hit) AS n_hit, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS kept
  FROM marked GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_hit, 0) AS n_removed,
       sha256(CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END) AS text_sha256
FROM docs LEFT JOIN texts USING (rid)
"""

ORACLE_SQL["op11_hard_negatives"] = """
WITH own AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, own.vec_id AS id, a.label = own.label AS same, CAST(list_dot_product(a.q, own.q) AS BIGINT) AS score
  FROM own AS a JOIN own ON a.vec_id % 100 = 0 AND a.vec_id <> own.vec_id AND len(a.q) = len(own.q)),
positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scores AS n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
"""

ORACLE_SQL["op12_turn_repair"] = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
summed AS (  -- crc32 of k: each byte, then eight shifts
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(k) + 1),
             lambda i: [CAST(unicode(k[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS h
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM summed, (VALUES (1), (2)) AS c(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, role[1] AS initial
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial NOT IN ('su', 'ua', 'au'), false) AS odd
  FROM ordered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (odd) AS illegal, max(p) AS n
  FROM faulty GROUP BY conv_id),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
turned(st, nxt, who) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
kept(st, initial, nxt) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
added(st, nxt, price, edit, lines) AS (
  SELECT st, st, 0, '', CAST([] AS VARCHAR[]) FROM turned UNION ALL SELECT st, nxt, 3, 'I', [who] FROM turned
  UNION ALL SELECT a.st, b.nxt, 6, 'II', [a.who, b.who] FROM turned AS a JOIN turned AS b ON a.nxt = b.st),
steps AS (
  SELECT conv_id, p, st, st AS nxt, 4 AS price, 'D' AS edit, CAST([] AS VARCHAR[]) AS lines FROM faulty, turned
  UNION ALL SELECT conv_id, p, kept.st, kept.nxt, CASE WHEN fault = 3 THEN 3 ELSE 0 END, 'K', [role || ':' || text]
    FROM faulty JOIN kept USING (initial) WHERE fault IN (0, 3)
  UNION ALL SELECT conv_id, p, st, nxt, CASE WHEN fault = 3 THEN 6 ELSE 3 END, 'R', [who || text] FROM faulty, turned WHERE fault IN (0, 3)),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS p, nxt AS st, {'cost': price, 'audit': edit, 'lines': lines} AS best FROM counts, added WHERE st = 0
    QUALIFY row_number() OVER (PARTITION BY conv_id, nxt ORDER BY price, edit) = 1
  UNION ALL
  SELECT conv_id, p, st, min(best) FROM (
    SELECT w.conv_id, s.p, a.nxt AS st, {'cost': w.best.cost + s.price + a.price, 'audit': w.best.audit || s.edit || a.edit,
                                         'lines': w.best.lines || s.lines || a.lines} AS best
    FROM ways AS w JOIN steps AS s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.p = w.p + 1 AND s.st = w.st JOIN added AS a ON a.st = s.nxt)
  GROUP BY conv_id, p, st),
ended AS (
  SELECT c.conv_id, min(w.best) AS best FROM counts AS c JOIN ways AS w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.p = c.n AND w.st IN (0, 3)
  GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counts AS c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended AS e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLE_SQL["op13_fingerprints"] = r"""
WITH own AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
paired AS (
  SELECT doc_id, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS nxt FROM own
  WINDOW o AS (ORDER BY doc_id NULLS FIRST, t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edited AS (SELECT *, substr(t, 1, length(t) - length(t) // 4) || substr(nxt, 1, length(t) // 4) AS e FROM paired),
texts AS (SELECT DISTINCT t FROM (SELECT t FROM own UNION ALL SELECT e FROM edited)),
worded AS (
  SELECT t, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM texts),
hashed AS (
  SELECT t, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1),
                      lambda i: md5(array_to_string(list_slice(w, i, i + 4), ' '))[1:16]))) AS h
  FROM worded),
kept AS (SELECT t, h, list_filter(h, lambda x: x < '4000000000000000') AS k FROM hashed),
prints AS (SELECT t, CASE WHEN len(k) > 0 THEN k ELSE h[1:1] END AS f FROM kept)
SELECT doc_id, CAST(length(d.t) AS BIGINT) AS n_chars, sha256(e) AS edited_sha256, array_to_string(a.f, ',') AS fingerprint,
       array_to_string(b.f, ',') AS edited_fingerprint,
       CASE WHEN len(a.f) + len(b.f) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a.f, b.f))::DOUBLE / (len(a.f) + len(b.f) - len(list_intersect(a.f, b.f))) END AS near_edited,
       CASE WHEN len(a.f) + len(c.f) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a.f, c.f))::DOUBLE / (len(a.f) + len(c.f) - len(list_intersect(a.f, c.f))) END AS near_next
FROM edited AS d JOIN prints AS a ON a.t = d.t JOIN prints AS b ON b.t = d.e JOIN prints AS c ON c.t = d.nxt
"""
