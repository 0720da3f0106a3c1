"""DuckDB twins of the queries that SQL can express, written on their own."""

from __future__ import annotations

import string

_BASE32 = string.ascii_uppercase + "234567"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS n,
             max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + CAST((CAST('0x' || substr(d, CAST(1 + (i // 4) * 5 AS BIGINT), 5)
         AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n > 1 THEN top END AS refers_to
FROM r"""

OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS size,
              array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
       FROM d, sizes, unnest(range(1, len(w) - size + 2)) t(i)),
hits AS (SELECT rid, i, dw.size, item FROM dw JOIN bw ON dw.g = bw.g AND dw.size = bw.size),
covered AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM hits) GROUP BY rid),
found AS (SELECT rid, list(item ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""

_PIECES = f"regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')"

OP12 = f"""
WITH p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
grams AS (SELECT lang, unnest(w) AS g FROM p
          UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM p
          UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM p),
f AS (SELECT lang, g, count(*) AS n FROM grams GROUP BY lang, g HAVING count(*) >= 10),
c AS (SELECT lang, n, string_split(g, ' ') AS ws FROM f WHERE contains(g, ' ')),
parts AS (SELECT lang, ws, n AS a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest
          FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM c)),
cuts AS (SELECT c.lang, c.ws, c.a, c.k, l.n AS l, r.n AS r,
                CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.n AS HUGEINT) * r.n) AS BIGINT) AS score
         FROM parts c JOIN f l ON l.lang = c.lang AND l.g = c.first JOIN f r ON r.lang = c.lang AND r.g = c.rest),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
inside AS (SELECT lang, ws, max(n) AS n FROM (SELECT lang, ws[1:2] AS ws, n FROM c WHERE len(ws) = 3
           UNION ALL SELECT lang, ws[2:3] AS ws, n FROM c WHERE len(ws) = 3) GROUP BY lang, ws),
kept AS (SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.ws = b.ws
         WHERE i.n IS NULL OR 100 * i.n < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

SQL = {"op3_warc": OP3, "op9_decontamination": OP9, "op12_phrases": OP12}
