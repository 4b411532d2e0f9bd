"""DuckDB SQL for the queries of this subpackage that SQL can express."""

# Rows that repeat doc_id and text are one document.
OP7 = """
SELECT DISTINCT
       doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP8 = """
WITH tab AS (
  SELECT list(v ORDER BY c) AS t FROM (
    SELECT c, list_reduce(list_prepend(c, range(8)), lambda a, b:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS c))),
bytes AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents),
sized AS (
  SELECT doc_id, strlen(text)::BIGINT + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])),
             4294967295) AS text_crc32
  FROM bytes, tab),
placed AS (
  SELECT *, least(15, ((2 * (sum(size) OVER w - size) + size) * 16) // (2 * sum(size) OVER ()))::INT AS shard
  FROM sized WINDOW w AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
       NULL::INT AS grown_shard
FROM placed
"""

# Rows of one vec_id count once; every pair of an anchor and a row is looked at.
OP11 = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
kept AS (SELECT vec_id, label, v FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY label, v) AS r FROM sound) WHERE r = 1),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS r FROM pairs WHERE same) WHERE r <= 5),
negatives AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""

# Levels of all trees, each node's siblings, and every leaf's way up; only the parity of the CRC matters.
OP13 = """
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY c) AS t FROM (
    SELECT c, list_reduce(list_prepend(c, range(8)), lambda a, b:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS c))),
told AS (
  SELECT doc_id, text, coalesce('s' || source, '') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
               lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 2 = 0 AS even
  FROM documents, tab),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN even THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS shown
  FROM told),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
levels AS (
  SELECT tree, 0 AS h, pos, leaf AS node, n FROM placed
  UNION ALL
  SELECT tree, h + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM levels WHERE n > 1 GROUP BY tree, h, pos // 3, n),
subroots AS (
  SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS h, pos, subroot AS node, n FROM subroots
  UNION ALL
  SELECT h + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY h, pos // 3, n),
beside AS (
  SELECT tree, h, pos, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, h, pos, node FROM levels WHERE n > 1
        UNION ALL SELECT '/', h, pos, node FROM tops WHERE n > 1)
  WINDOW w AS (PARTITION BY tree, h, pos // 3 ORDER BY pos)),
ways AS (
  SELECT doc_id, tree AS own, tree, 0 AS h, pos, n, leaf, coalesce(shown, leaf) AS node, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, own, CASE WHEN w.n > 1 THEN w.tree ELSE '/' END, CASE WHEN w.n > 1 THEN w.h + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.pos // 3 ELSE s.pos END, CASE WHEN w.n > 1 THEN (w.n + 2) // 3 ELSE s.n END,
         leaf, CASE WHEN w.n > 1 THEN sha256(b.l || w.node || b.r) ELSE w.node END, CASE WHEN w.n > 1 THEN proof || b.l || b.r ELSE proof END
  FROM ways w LEFT JOIN beside b ON b.tree = w.tree AND b.h = w.h AND b.pos = w.pos JOIN subroots s ON s.tree = w.own
  WHERE w.n > 1 OR w.tree <> '/')
SELECT w.doc_id, w.leaf, s.subroot, r.node AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = r.node AS verified
FROM ways w JOIN subroots s ON s.tree = w.own, (SELECT node FROM tops WHERE n = 1) r
WHERE w.tree = '/' AND w.n = 1
"""

ORACLES = {"op7_exact_dedup": OP7, "op8_byte_shards": OP8, "op11_hard_negatives": OP11, "op13_merkle_manifest": OP13}
