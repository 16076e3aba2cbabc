"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
w AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS has_word,
         sum(regexp_matches(line, '[^\x20\x09-\x0D]')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM l),
v AS (
  SELECT doc_id, k, line, lead(line, 1) OVER o AS line2, lead(line, 2) OVER o AS line3, count(*) OVER (PARTITION BY doc_id) AS n,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w1,
         len(regexp_extract_all(lead(line, 1) OVER o, '[^\x20\x09-\x0D]+')) AS w2
  FROM w WHERE has_word WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
u AS (
  SELECT doc_id, k, [line, line2, line3] AS s FROM v WHERE line3 IS NOT NULL
  UNION ALL SELECT doc_id, k, [line] FROM v WHERE w1 >= 20 OR n = 1
  UNION ALL SELECT doc_id, k, [line, line2] FROM v WHERE (w1 < 20 AND w1 + w2 >= 20) OR (n = 2 AND k = 1)),
r AS (SELECT doc_id, k, len(s) AS size, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) > 1 AS late FROM u),
g AS (SELECT DISTINCT doc_id, unnest(range(k::BIGINT, k::BIGINT + size)) AS k FROM r WHERE late),
m AS (
  SELECT w.*, has_word AND g.k IS NOT NULL AS gone
  FROM w LEFT JOIN g ON w.doc_id = g.doc_id AND w.k = g.k)
SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
u AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * o >= 75 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (
  SELECT doc_id AS x, doc_id AS c FROM n
  UNION
  SELECT e.y, r.c FROM r JOIN e ON e.x = r.x WHERE r.c < e.y)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id
FROM n JOIN r ON r.x = n.doc_id GROUP BY 1, 2
"""

OP3 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS kept FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, strlen(p.h) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN p.page_id <> g.kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> g.kept THEN g.kept END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY source),
a AS (
  SELECT *, 2 * source_size AS cap, 3 * sum(source_size) OVER () AS budget,
         sum(weight) OVER () AS all_w,
         coalesce(sum(2 * source_size) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS w_before
  FROM s
  WINDOW o AS (ORDER BY (2 * source_size)::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, 2 * cap * (all_w - w_before) <= weight * (budget - 2 * cap_before) AS capped FROM a),
c AS (
  SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS cap_sum,
         all_w - coalesce(sum(CASE WHEN capped THEN weight END) OVER (), 0) AS free_w
  FROM b),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (weight * (budget - 2 * cap_sum))::BIGINT::DOUBLE / (2 * free_w)::BIGINT::DOUBLE END AS target
  FROM c),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
h AS (
  SELECT source, place, sum(size) AS size FROM d GROUP BY source, place),
m AS (
  SELECT h.source, h.place,
         sum(h.size) OVER (PARTITION BY h.source ORDER BY h.place) - h.size / 2.0
           <= r.target - r.whole * r.source_size AS inside
  FROM h JOIN r ON h.source IS NOT DISTINCT FROM r.source)
SELECT d.doc_id, d.size::BIGINT AS size, r.source_size, r.target,
       (d.size * (r.whole + CASE WHEN m.inside THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.place = m.place
"""

OP9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
v AS (
  SELECT doc_id, i, word, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM u
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS late FROM v WHERE n = 20),
m AS (
  SELECT v.doc_id, v.i, v.word,
         coalesce(bool_or(r.late) OVER (PARTITION BY v.doc_id ORDER BY v.i
                                        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM v LEFT JOIN r ON v.doc_id = r.doc_id AND v.i = r.i),
k AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
i AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY 1, 2),
g AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
m AS (SELECT doc_id, 75 + (25 * len(w) * n_docs) // n_words AS m FROM d, g WHERE len(w) > 0),
u AS (SELECT doc_id, unnest(w) AS term FROM d),
f AS (SELECT doc_id, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
t AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM f, g GROUP BY term, n_docs),
s AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def _op13(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Each round as two CTEs: the nearest centroid of every vector, the moved centroids."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (
    SELECT e.vec_id, c.cluster, sum((e.x - c.x) * (e.x - c.x))::BIGINT AS distance,
           row_number() OVER (PARTITION BY e.vec_id ORDER BY sum((e.x - c.x) * (e.x - c.x)), c.cluster) AS place
    FROM e JOIN c{r} c ON c.i = e.i GROUP BY e.vec_id, c.cluster)
  WHERE place = 1)"""
    move = """m{r} AS (
  SELECT a.cluster, e.i, sum(e.x)::BIGINT AS s, count(*) AS n FROM a{r} a JOIN e USING (vec_id) GROUP BY 1, 2),
c{s} AS MATERIALIZED (
  SELECT cluster, i, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{r} c LEFT JOIN m{r} USING (cluster, i))"""
    parts = [f"""k AS (
  SELECT vec_id, embedding,
         row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR)) - 1 AS place
  FROM embeddings
  WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dim})""",
             """e AS MATERIALIZED (
  SELECT vec_id, place, unnest(range(len(embedding))) AS i,
         unnest([floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding]) AS x FROM k)""",
             f"c0 AS MATERIALIZED (SELECT place::INT AS cluster, i, x FROM e WHERE place < {k})"]
    for r in range(rounds):
        parts += [nearest.format(r=r), move.format(r=r, s=r + 1)]
    parts.append(nearest.format(r=rounds))
    last = f"{rounds}"
    return f"""WITH {", ".join(parts)},
h AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY 1)
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{last} JOIN h USING (cluster)
"""


ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1, "op2_ngram_jaccard_join": OP2, "op3_exact_dedup": OP3, "op7_warc": OP7, "op8_mixing": OP8,
    "op9_substring_dedup": OP9, "op11_lexical_search": OP11, "op13_centroid_clustering": _op13(),
}
