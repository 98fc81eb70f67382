"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

_WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_REACH = """reach(x, y) AS (
  SELECT id, id FROM nodes UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a)"""

OP1 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.95),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.x = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, w FROM d),
h AS (
  SELECT doc_id, word, i, CASE WHEN i + 34 <= n THEN md5(array_to_string(w[i:i + 34], ' ')) END AS h FROM p),
r AS (SELECT h FROM h WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
c AS (
  SELECT doc_id, word, i, max(CASE WHEN r.h IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM h LEFT JOIN r ON h.h = r.h),
k AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, CAST(sum(gone) AS BIGINT) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS kept_sha256
  FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
  coalesce(k.kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id AS id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
both_ AS (SELECT p.id AS a, q.id AS b, count(*) AS k FROM s p JOIN s q ON p.g = q.g AND p.id <> q.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM both_ JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
nodes AS (SELECT id FROM d),
{_REACH}
SELECT d.id AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n ON n.id = d.id JOIN reach r ON r.x = d.id GROUP BY ALL"""

OP9 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
l AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM (SELECT doc_id, b, unnest(range(1, n - 398)) AS i FROM l WHERE n >= 400)),
r AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
f AS (SELECT doc_id, i FROM w SEMI JOIN r ON w.h = r.h),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM f)),
x AS (SELECT doc_id, run, min(i) AS first, max(i) + 399 AS last FROM g GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, lag(last, 1, 0) OVER (PARTITION BY doc_id ORDER BY first) + 1 AS first, first - 1 AS last FROM x
  UNION ALL SELECT x.doc_id, max(last) + 1, any_value(n) FROM x JOIN l ON l.doc_id = x.doc_id GROUP BY x.doc_id),
kept AS (
  SELECT gaps.doc_id, unhex(coalesce(string_agg(hex(b[gaps.first:gaps.last]), '' ORDER BY gaps.first) FILTER (WHERE gaps.last >= gaps.first), '')) AS k
  FROM gaps JOIN l ON l.doc_id = gaps.doc_id GROUP BY gaps.doc_id),
gone AS (SELECT doc_id, sum(last - first + 1) AS n_removed, count(*) AS n_spans FROM x GROUP BY doc_id)
SELECT l.doc_id, CAST(l.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(k, b)) AS kept_sha256
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id LEFT JOIN kept ON kept.doc_id = l.doc_id"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""
