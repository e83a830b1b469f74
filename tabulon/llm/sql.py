"""DuckDB SQL of the operators' queries."""

from __future__ import annotations

#: Lower-cases A-Z alone.
_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(t='coalesce(text, chr(32))')},
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all({_LOWER.format(t='text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, list_aggregate(w[p:p + least(len(w), 10) - 1], 'string_agg', ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, p, k, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT dw.doc_id, dw.p, dw.k, iw.item FROM dw JOIN iw USING (k, g)),
cover AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM hits)) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS s, sha256(body) AS d FROM p),
b AS (
  SELECT h.*, list_aggregate(list_transform(range(32), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(s, 5 * (j // 4)::INT + 1, 5))::INT >> (15 - 5 * (j % 4)::INT)) & 31) + 1)::INT, 1)),
    'string_agg', '') AS payload_digest FROM h),
t AS (SELECT d, max(page_id) AS top FROM h GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM b JOIN t USING (d)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(t="coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[p:p + least(len(w), 5) - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON a = doc_id
"""

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format(t="coalesce(text, '')")},
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM o GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(df) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
e AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS all_n
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM e GROUP BY ALL),
p AS (
  SELECT e.lang, e.source, e.term, e.n, 1 + (1000000000::HUGEINT * (e.n + 2)) // (t.total + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (e.all_n + 2)) // (v.total + 2 * v.v) AS q
  FROM e JOIN t ON e.lang = t.lang AND e.source = t.source JOIN v ON v.lang = e.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: CRC-32 bit by bit, then the cheapest repair from the last turn to the first.
REPAIR = r"""
WITH RECURSIVE b AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda c: ord(c)::BIGINT)),
           lambda s, c: list_reduce(list_concat([xor(s, c)], range(8)),
             lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS f FROM b),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM x WHERE f <> 0),
o AS (
  SELECT coalesce(conv_id::VARCHAR, 'null') AS c, turn, role, text, left(role, 1) AS i,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS w FROM d),
r AS (
  SELECT *, w = '' AS blank, w <> '' AND seen AS dup, w <> '' AND NOT seen AND right(w, 1) NOT IN ('.', '!', '?') AS cut,
         lag(i) OVER (PARTITION BY c ORDER BY k) AS before FROM o),
n AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY c),
-- s: for each state (1 nothing yet, 2 after system, 3 after user, 4 after assistant) cost, letters and text of the rest
z AS (
  SELECT c, n + 1 AS k, [{'c': 0, 'a': '', 't': ''}, {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'},
                         {'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 't': ''}] AS s FROM n
  UNION ALL
  SELECT c, k, list_transform(one, lambda m, q: least(m, {'c': one[nxt[q]].c + 2, 'a': 'I' || one[nxt[q]].a,
                                                         't': chr(10) || who[q] || ':' || one[nxt[q]].t}))
  FROM (
    SELECT c, k, nxt, who, list_transform(bare, lambda m, q: least(m, {'c': bare[nxt[q]].c + 2, 'a': 'I' || bare[nxt[q]].a,
                                                                       't': chr(10) || who[q] || ':' || bare[nxt[q]].t})) AS one
    FROM (
      SELECT c, k, nxt, who, list_transform([1, 2, 3, 4], lambda q: list_min(list_filter([
          {'c': s[q].c + 3, 'a': 'D' || s[q].a, 't': s[q].t},
          CASE WHEN go AND keep[q] > 0 THEN {'c': s[keep[q]].c + cut, 'a': 'K' || s[keep[q]].a,
                                             't': chr(10) || role || ':' || text || s[keep[q]].t} END,
          CASE WHEN go THEN {'c': s[nxt[q]].c + 2 + cut, 'a': 'R' || s[nxt[q]].a,
                             't': chr(10) || who[q] || ':' || text || s[nxt[q]].t} END], lambda e: e IS NOT NULL))) AS bare
      FROM (
        SELECT z.c, z.k - 1 AS k, z.s, r.role, r.text, r.cut::INT AS cut, NOT (r.blank OR r.dup) AS go,
               [3, 3, 4, 3] AS nxt, ['user', 'user', 'assistant', 'user'] AS who,
               CASE r.i WHEN 's' THEN [2, 0, 0, 0] WHEN 'u' THEN [3, 3, 0, 3] WHEN 'a' THEN [0, 0, 4, 0] ELSE [0, 0, 0, 0] END AS keep
        FROM z JOIN r ON r.c = z.c AND r.k = z.k - 1)))),
best AS (SELECT c, s[1].c AS cost, s[1].a AS audit, substr(s[1].t, 2) AS whole FROM z WHERE k = 1)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS c FROM conversations) i LEFT JOIN n USING (c) LEFT JOIN best USING (c)
"""
