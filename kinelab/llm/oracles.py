"""SQL over the raw tables for the queries that SQL can express."""

from __future__ import annotations

from kinelab.llm.licenses import COVERED, LONG, SHIFT, SHORT, template_grams

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def _op4() -> str:
    rows = ", ".join("('{}', {}, {}, {}, {}, '{}')".format(label, str(phrase).lower(), *rest) for label, phrase, *rest in template_grams())
    return f"""
WITH t(label, phrase, template, size, pos_in, gram) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM d),
g AS (SELECT r, pos, word || ' ' || lead(word) OVER o AS g2,
             word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o AS g4
      FROM w WINDOW o AS (PARTITION BY r ORDER BY pos)),
v AS (SELECT r, label, phrase, template, size, pos_in, pos, pos - pos_in AS diagonal FROM g JOIN t ON phrase AND gram = g2
      UNION ALL
      SELECT r, label, phrase, template, size, pos_in, pos, pos - pos_in FROM g JOIN t ON NOT phrase AND gram = g4),
places AS (SELECT r, label, diagonal AS start, 1.0::DOUBLE AS score FROM v WHERE phrase
           GROUP BY r, template, label, diagonal, size HAVING count(*) = size - {SHORT - 1}),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {SHIFT} THEN 0 ELSE 1 END AS new FROM v WHERE NOT phrase
      WINDOW o AS (PARTITION BY r, template ORDER BY diagonal, pos_in)),
s AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal, pos_in) AS span FROM n),
spans AS (SELECT r, label, size, len(list_distinct(flatten(list_transform(list(pos_in), lambda i: range(i, i + {LONG}))))) AS v, min(pos) AS lo, max(pos) AS hi FROM s GROUP BY r, template, label, size, span),
verified AS (SELECT r, label, NULL AS start, (v::DOUBLE / size) AS score FROM spans
             WHERE (v::DOUBLE / size) >= {COVERED}
               AND abs(hi + {LONG} - lo - size) <= size * {1 - COVERED} + {SHIFT}),
a AS (SELECT * FROM places UNION ALL SELECT * FROM verified),
x AS (SELECT r, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
             string_agg(DISTINCT CASE WHEN start IS NOT NULL THEN label END, ',' ORDER BY CASE WHEN start IS NOT NULL THEN label END) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
      FROM a GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN x USING (r)
"""


OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
r(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, p.b FROM r JOIN p ON r.c = p.a),
m AS (SELECT id, min(c) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON vec_id = m.id LEFT JOIN n ON vec_id = n.a
"""

OP7 = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, ([3, 1, 2])[((rank - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size::DOUBLE * 2 AS cap FROM s1),
s3 AS (SELECT *, cap / weight AS ratio FROM s2),
s4 AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
              sum(cap) OVER (ORDER BY ratio, rank) - cap AS capped,
              sum(weight) OVER () - (sum(weight) OVER (ORDER BY ratio, rank) - weight) AS open FROM s3),
s5 AS (SELECT *, (budget - capped) / open AS level FROM s4),
c AS (SELECT arg_min(level, {'a': ratio, 'b': rank}) AS common FROM s5 WHERE level <= ratio),
tg AS (SELECT source, rank, source_size,
              CASE WHEN source_size = 0 THEN 0::DOUBLE WHEN ratio <= common THEN cap ELSE weight * common END AS target
       FROM s5 LEFT JOIN c ON true),
k AS (SELECT greatest(1, sum(source_size)::BIGINT // 65536) AS block, sum(source_size)::BIGINT AS total FROM s0),
n AS (SELECT tg.*, block, ceil(source_size::DOUBLE / block)::BIGINT AS n, (3 * total + block) // (2 * block) AS seats FROM tg, k),
q AS (SELECT rank, target, seats, unnest(range(0, 2 * n)) AS k FROM n WHERE target > 0),
aw AS (SELECT rank, seats, row_number() OVER (ORDER BY target / (k * 2 + 1) DESC, rank) - 1 AS award FROM q),
qt AS (SELECT rank, count(*) AS quota FROM aw WHERE award < seats GROUP BY rank),
b0 AS (SELECT n.rank, source_size, n.n, block AS size, coalesce(quota, 0) AS quota, unnest(range(0, n.n)) AS block FROM n LEFT JOIN qt USING (rank) WHERE source_size > 0),
b1 AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY md5('mix-1|' || rank || '|' || block), block) AS place FROM b0),
b2 AS (SELECT *, quota // n + CASE WHEN place <= quota % n THEN 1 ELSE 0 END AS times FROM b1),
b3 AS (SELECT *, times * least(size, source_size - block * size) AS words FROM b2),
b AS (SELECT rank, block, times, sum(words) OVER (PARTITION BY rank ORDER BY block) - words AS base FROM b3),
h AS (SELECT d.doc_id, d.size, tg.rank, tg.source_size, tg.target, md5('mix-1|' || d.doc_id) AS key FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source),
l AS (SELECT *, sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS e FROM h),
o AS (SELECT l.*, k.block AS w, (e - size) // k.block AS x, (e - 1) // k.block AS y FROM l, k)
SELECT o.doc_id, o.size, o.source_size, o.target,
       (CASE WHEN o.size > 0 THEN (z.base + z.times * (o.e - o.y * w)) - (a.base + a.times * (o.e - o.size - o.x * w)) ELSE 0 END)::BIGINT AS taken
FROM o LEFT JOIN b a ON a.rank = o.rank AND a.block = o.x LEFT JOIN b z ON z.rank = o.rank AND z.block = o.y
"""

OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, CASE WHEN len(words) = 1 THEN words ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM t),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(id, c) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.id, p.b FROM r JOIN p ON r.c = p.a),
m AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM t JOIN m ON doc_id = id
"""

OP13 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
      FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER o)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER o <= 3
"""

SQL = {
    "op1_warc": OP1,
    "op4_licenses": _op4(),
    "op5_vector_links": OP5,
    "op7_mixture": OP7,
    "op9_near_duplicates": OP9,
    "op13_hard_negatives": OP13,
}
