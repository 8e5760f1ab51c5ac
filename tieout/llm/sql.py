"""The same results in DuckDB's SQL, written from the contracts and not from the plans."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.n <> q.n
  WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# Every quotient of every seat is listed and ranked here, for the sources and
# then for the shards; the plan ranks only those near the last one.
MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM documents
),
docs AS (SELECT *, draw % 1024 AS shard FROM d),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source
),
rounds AS (
  SELECT 0 AS step, source, source_size, weight, false AS capped FROM src
  UNION ALL
  SELECT step + 1, source, source_size, weight,
    capped OR 3 * source_size < (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
      * weight / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0)
  FROM rounds WHERE step < (SELECT count(*) FROM src)
),
target AS (
  SELECT source, source_size,
    CASE WHEN capped THEN 3.0 * source_size ELSE (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
      / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) * weight END::DOUBLE AS target
  FROM rounds WHERE step = (SELECT count(*) FROM src)
),
shard AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, sum(size)::BIGINT * 3 // 16 AS room FROM docs GROUP BY source, shard
),
room AS (SELECT source, target, source_size * 3 // 16 AS room FROM target),
seats AS (
  SELECT source, count(*) AS seats FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST) AS place
    FROM (SELECT source, target, unnest(range(1, room + 1)) AS k FROM room)
  ) WHERE place <= (SELECT floor(sum(size)::DOUBLE / 16 + 0.5) FROM docs) GROUP BY source
),
share AS (
  SELECT t.source, CASE WHEN t.target >= 3 * t.source_size THEN 3 * t.source_size ELSE coalesce(s.seats, 0) * 16 END::BIGINT AS words
  FROM target t LEFT JOIN seats s ON t.source IS NOT DISTINCT FROM s.source
),
won AS (
  SELECT q.source, shard, count(*) AS blocks FROM (
    SELECT source, shard, row_number() OVER (PARTITION BY source ORDER BY shard_size::DOUBLE / (2 * k - 1) DESC, shard) AS place
    FROM (SELECT source, shard, shard_size, unnest(range(1, room + 1)) AS k FROM shard)
  ) q JOIN share s ON q.source IS NOT DISTINCT FROM s.source WHERE place <= words // 16 GROUP BY q.source, shard
),
-- a source that needs more than all whole blocks takes what is below a block, shard after shard
given AS (
  SELECT s.source, s.shard, s.shard_size, coalesce(w.blocks, 0) * 16 AS whole, s.shard_size * 3 - s.room * 16 AS below,
    h.words - sum(s.room) OVER of_source * 16 AS missing, sum(coalesce(w.blocks, 0)) OVER of_source = sum(s.room) OVER of_source AS all_blocks,
    sum(s.shard_size * 3 - s.room * 16) OVER (PARTITION BY s.source ORDER BY s.shard) - (s.shard_size * 3 - s.room * 16) AS before
  FROM shard s JOIN share h ON s.source IS NOT DISTINCT FROM h.source
  LEFT JOIN won w ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard
  WINDOW of_source AS (PARTITION BY s.source)
),
ring AS (
  SELECT doc_id, source, shard, size,
    sum(size) OVER (PARTITION BY source, shard ORDER BY draw, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM docs
),
words AS (
  SELECT r.*, s.shard_size AS total,
    (s.whole + CASE WHEN s.all_blocks THEN greatest(0, least(s.below, s.missing - s.before)) ELSE 0 END)::BIGINT AS words,
    CASE WHEN s.shard_size > 0 THEN ('0x' || substr(md5('mix-1:start:' || coalesce(r.source, '') || ':' || r.shard), 1, 15))::BIGINT % s.shard_size ELSE 0 END AS first
  FROM ring r JOIN given s ON r.source IS NOT DISTINCT FROM s.source AND r.shard = s.shard
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN total = 0 THEN 0 ELSE
    (words // total) * size
    + greatest(0, least(start + size, first + words % total, total) - greatest(start, first))
    + greatest(0, least(start + size, first + words % total - total) - start)
  END)::BIGINT AS taken
FROM words w JOIN target t ON w.source IS NOT DISTINCT FROM t.source
"""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=LOWER)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
),
reach AS (SELECT a AS doc_id, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, min(r.b)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""

REPEATED_WORDS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
v AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS g
  FROM w WHERE len(ws) >= 13
),
hit AS (SELECT doc_id, i FROM v JOIN (SELECT g, min(doc_id) AS least FROM v GROUP BY g) USING (g) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM hit),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS k
  FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def walsh_clusters(k: int = 40, rounds: int = 5) -> str:
    """Plain assignment by distances between the vectors themselves, one step per round."""
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, e) - 1 AS cluster, e AS c FROM v
  ORDER BY 1 LIMIT {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""d{r} AS (
  SELECT n, cluster, list_sum(list_transform(list_zip(e, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
  FROM v, c{r}
),
a{r} AS MATERIALIZED (
  SELECT n, cluster, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY n ORDER BY distance, cluster) = 1
)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} AS (
  SELECT cluster, i, sum(x) AS s, count(*) AS k FROM (
    SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v JOIN a{r} USING (n)
  ) GROUP BY cluster, i
),
c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(l, c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, list((CASE WHEN s < 0 THEN -((-s + k - 1) // k) ELSE s // k END)::BIGINT ORDER BY i) AS l FROM m{r} GROUP BY cluster
  ) USING (cluster)
)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (n) JOIN c{rounds} USING (cluster)
"""
    )


ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard": NEAR_DUPLICATES,
    "op5_substring_dedup": REPEATED_WORDS,
    "op6_exact_dedup_tree": EXACT_DEDUP,
    "op7_exact_topk": TOP_K,
    "op10_mixing": MIXING,
    "op12_walsh_clusters": walsh_clusters(),
}
