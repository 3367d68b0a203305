"""DuckDB SQL for the operators that it can express, each written plainly: every window, every pair that shares a shingle."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK, _ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_BLANK}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * k >= 85 * (m.n + o.n - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

DECONTAMINATE = f"""
WITH b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
h AS (SELECT doc_id, l, i, item_id FROM dw JOIN bw USING (l, s)),
k AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
x AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
c AS (SELECT doc_id, i FROM x QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT *, CASE WHEN i <= lag(i) OVER o + 35 THEN 0 ELSE 1 END AS new FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 35 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d),
k AS (SELECT p.doc_id, count(*) AS n, string_agg(w[j], ' ' ORDER BY j) AS kept FROM p LEFT JOIN s ON s.doc_id = p.doc_id AND j >= a AND j < b WHERE a IS NULL GROUP BY p.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

SUFFIX = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
c AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
g AS (SELECT *, CASE WHEN i <= lag(i) OVER o + 100 THEN 0 ELSE 1 END AS new FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
m AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS gone, max(b) AS last FROM s GROUP BY doc_id),
q AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_, a AS to_ FROM s UNION ALL SELECT doc_id, n + 1, coalesce(last, 0), n FROM d LEFT JOIN m USING (doc_id)),
k AS (SELECT doc_id, string_agg(substr(x, 2 * from_ + 1, 2 * (to_ - from_)), '' ORDER BY a) AS kept FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)
"""
