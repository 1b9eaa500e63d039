"""The registered queries as DuckDB SQL, where SQL can state them and ends in time at sf0.01."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

_NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a WHERE r.a <> l.b),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN lowest ON a = d.doc_id
"""

_DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, l, array_to_string(w[k:k + l - 1], ' ') AS win FROM (
  SELECT item_id, w, least(13, len(w)) AS l, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k
  FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT doc_id, k, l, array_to_string(w[k:k + l - 1], ' ') AS win FROM (
  SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM d, lengths WHERE len(w) >= l)),
f AS (SELECT doc_id, k, dw.l, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.l = iw.l),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + l)) AS p FROM f) GROUP BY 1),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM f) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""

_SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
r AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM t),
v AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS reach FROM r),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
    ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY reach, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here FROM v),
m AS (SELECT max(here) AS level FROM l WHERE here < reach),
x AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target,
    CAST(floor(least(cap, coalesce(level * weight, cap)) + 0.5) AS BIGINT) AS budget FROM l, m),
p AS (SELECT doc_id, size, source_size, target, budget,
    CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, CAST(passes * size + greatest(0, least(size,
  budget - passes * source_size - ahead)) AS BIGINT) AS taken FROM p
"""

_WEB_ARCHIVE = """
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first_id FROM d GROUP BY 1)
SELECT page_id, octet_length(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(d.hex, 1 + i * 5 // 4, 2) AS INT) >> CAST(3 - (5 * i) % 4 AS INT)) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (hex)
"""

_SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT row) >= 30),
c AS (SELECT lang, source, term, count(*) AS count FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY 1),
n AS (SELECT lang, source, sum(count) AS n FROM c GROUP BY 1, 2),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(n, 0)::HUGEINT AS n, coalesce(v, 0)::HUGEINT AS v,
         coalesce(lang_n, 0)::HUGEINT AS lang_n FROM g LEFT JOIN n USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT lang, source, term, count, n, 1 + (1000000000::HUGEINT * (coalesce(count, 0) + 5)) // (n + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // (lang_n + 5 * v) AS q
  FROM gn JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE count > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

_TOPK_SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS l,
    row_number() OVER () AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row AS query, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.l) + 1), lambda i: q.l[i] * c.l[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.l) = len(c.l) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_web_archive": _WEB_ARCHIVE,
    "op7_near_duplicates": _NEAR_DUPLICATES,
    "op8_decontamination": _DECONTAMINATION,
    "op9_source_mix": _SOURCE_MIX,
    "op11_source_divergence": _SOURCE_DIVERGENCE,
    "op12_topk_search": _TOPK_SEARCH,
}
