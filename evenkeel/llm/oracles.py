"""SQL that recomputes those training-data queries which SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_PLAIN = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) c ON c.a = d.doc_id
"""

DECONTAMINATION = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN.format(_LOWER)} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, list_slice(w, p, p + least(10, len(w)) - 1) AS x FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
widths AS (SELECT DISTINCT len(x) AS k FROM windows),
d AS (SELECT doc_id, {_PLAIN.format(_LOWER)} AS w FROM documents),
places AS (SELECT doc_id, p, k, list_slice(w, p, p + k - 1) AS x FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, widths WHERE len(w) >= k)),
found AS (SELECT doc_id, p, k, item FROM places JOIN windows USING (x)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_SPACED.format("coalesce(text, '')")}) AS BIGINT) AS size, md5('mix:' || doc_id) AS h FROM documents),
b AS (SELECT doc_id, source, size, CAST(('0x' || substr(h, 1, 4)) AS INTEGER) AS bucket, CAST(CAST(('0x' || substr(h, 5, 4)) AS INTEGER) AS DOUBLE) / 65536 AS part FROM d),
s AS (SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * source_size AS cap FROM (SELECT source, sum(size)::BIGINT AS source_size FROM b GROUP BY 1)),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped, sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, (SELECT sum(source_size) FROM s) AS total FROM s),
l AS (SELECT max(CAST(total - capped AS DOUBLE) / CAST(rest AS DOUBLE)) AS level FROM o WHERE cap > w * (CAST(total - capped AS DOUBLE) / CAST(rest AS DOUBLE))),
t AS (SELECT source, source_size, least(w * level, CAST(cap AS DOUBLE)) AS target FROM s, l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
x AS (SELECT *, target - whole * source_size AS rest FROM u),
g AS (SELECT source, bucket, sum(size)::BIGINT AS words FROM b GROUP BY 1, 2),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket)::BIGINT AS upto FROM g),
e AS (SELECT c.source, c.bucket AS last, (x.rest - c.upto + c.words) / c.words AS share FROM c JOIN x ON x.source IS NOT DISTINCT FROM c.source WHERE c.words > 0 AND c.upto - c.words < x.rest AND c.upto >= x.rest)
SELECT b.doc_id, b.size, x.source_size, x.target, CAST(x.whole * b.size + CASE WHEN b.bucket < coalesce(e.last, -1) THEN b.size WHEN b.bucket = e.last THEN CAST(floor(b.size * e.share + b.part) AS BIGINT) ELSE 0 END AS BIGINT) AS taken
FROM b JOIN x ON x.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON e.source IS NOT DISTINCT FROM b.source
"""

URL_FILTERS = r"""
WITH p AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '://[^?#]*\?([^#]*)', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|referrer|fbclid|gclid|mc_cid|mc_eid)(=|\z)'))) AS q FROM pages),
c AS (SELECT page_id, host, path, regexp_replace(host, '^www\.|\.?(:(80|443)?)?\z', '', 'g') || regexp_replace(path, '/+\z', '') || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS form FROM p),
listed AS (SELECT DISTINCT form FROM c WHERE regexp_matches(host, '(^|\.)(ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.')),
rules(says, h, t) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT page_id, arg_max(h || t, len(h || t)) AS rule, arg_max(says, len(h || t)) AS says FROM c JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t) GROUP BY 1)
SELECT c.page_id, host, path, rule, coalesce(says, CASE WHEN listed.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fits USING (page_id) LEFT JOIN listed ON listed.form = c.form
"""

_WORD_COUNT = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"
#: CRC-32 of an ASCII text, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, right(rtrim(text, E' \t\n\x0b\x0c\r'), 1) AS last FROM damaged),
t AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS r, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
counts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM (SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM t) GROUP BY 1),
moves(k, c, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
before(state, k, n) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
edits AS (SELECT conv_id, i, state, next, 2 * n + cost AS cost, repeat('I', n) || letter AS letters FROM (
  SELECT conv_id, i, k, k AS next, 3 AS cost, 'D' AS letter FROM t, (VALUES (0), (1), (2), (3)) AS s(k)
  UNION ALL SELECT conv_id, i, k, next, CASE WHEN c = r THEN 0 ELSE 2 END + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, CASE WHEN c = r THEN 'K' ELSE 'R' END FROM t JOIN moves ON c = r OR c <> 's' WHERE fault IN ('', 'truncated')) JOIN before USING (k)),
best AS (SELECT conv_id, n + 1 AS i, state, lpad(cost::VARCHAR, 12, '0') || audit AS b FROM counts, (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) AS e(state, cost, audit)
  UNION ALL SELECT e.conv_id, e.i, e.state, min(lpad((left(best.b, 12)::BIGINT + e.cost)::VARCHAR, 12, '0') || e.letters || substr(best.b, 13)) FROM best JOIN edits e ON e.conv_id IS NOT DISTINCT FROM best.conv_id AND e.i = best.i - 1 AND e.next = best.state GROUP BY 1, 2, 3),
audits AS (SELECT conv_id, left(b, 12)::BIGINT AS cost, substr(b, 13) AS audit FROM best WHERE i = 1 AND state = 0),
letters AS (SELECT conv_id, p, x, sum(CASE WHEN x = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN x = 'D' THEN 0 ELSE 1 END) OVER w AS place, length(replace(audit, 'D', '')) % 2 AS odd
  FROM (SELECT conv_id, audit, unnest(string_split(audit, '')) AS x, unnest(range(length(audit))) AS p FROM audits WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
turns AS (SELECT l.conv_id, l.place, CASE WHEN x = 'K' THEN t.role WHEN (l.place - 1) % 2 = odd THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE t.text END AS line FROM letters l LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i WHERE x <> 'D'),
texts AS (SELECT conv_id, string_agg(line, E'\n' ORDER BY place) AS s FROM turns GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(s, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM c.conv_id
"""

CONVERSATION_TRIE = f"""
WITH own AS (SELECT conv_id, {_WORD_COUNT.format("coalesce(text, '')")} AS words, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS print, turn, coalesce(role, '') AS role FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, print) AS pos FROM own),
c AS (SELECT conv_id, {_CRC32.format("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
r AS (SELECT c.conv_id, pos, print, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h UNION ALL SELECT c.conv_id, pos, print, words FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
p AS (SELECT c.conv_id, coalesce(path, []) AS path, coalesce(words, []) AS words FROM c LEFT JOIN (SELECT conv_id, list(print ORDER BY pos) AS path, list(words ORDER BY pos) AS words FROM r GROUP BY 1) USING (conv_id)),
m AS (SELECT conv_id, path, d, path[1:d] AS node, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM p)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = d), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
a AS (SELECT n.node[1:u] AS node, sum(saved) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM n) n LEFT JOIN k ON k.node = n.node GROUP BY 1)
SELECT n.conv_id, n.d AS depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN a ON a.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n parent ON n.d > 0 AND parent.node = n.node[1:n.d - 1]
"""
