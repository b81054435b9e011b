"""SQL of the registered queries, where another engine can express them."""

from __future__ import annotations

OP4_MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY source
), weighed AS (
  SELECT source, s, 2.0::DOUBLE * s AS cap,
         [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized
), steps AS (
  SELECT row_number() OVER o AS step, cap / w AS ratio,
         (sum(CAST(s AS DOUBLE)) OVER () * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WHERE s > 0
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST)
), aimed AS (
  SELECT source, s, least(cap, coalesce(
    (SELECT arg_min(level, step) FROM steps WHERE level <= ratio) * w, cap)) AS target
  FROM weighed
), keyed AS (
  SELECT source, k, sum(size) AS size FROM docs GROUP BY source, k
), lined AS (
  SELECT source, k, sum(size) OVER (PARTITION BY source ORDER BY k) - size / 2.0 AS middle FROM keyed
), planned AS (
  SELECT a.source, a.s, a.target,
         CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 1 END AS whole
  FROM aimed a
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, p.s AS source_size, p.target,
       CAST(d.size * (p.whole + CASE WHEN l.middle <= p.target - p.whole * p.s THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM docs d
JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
JOIN lined l ON d.source IS NOT DISTINCT FROM l.source AND d.k = l.k
"""


OP1_TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.e AS qe, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)
              AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (
           PARTITION BY query_id, qe ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP7_REPEATS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
), repeated AS (
  SELECT r, i FROM windows WHERE x IN (SELECT x FROM windows GROUP BY x HAVING count(*) > 1)
), covered AS (
  SELECT r, list(DISTINCT j) AS gone
  FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM repeated) GROUP BY r
), cut AS (
  SELECT doc_id, w, CASE WHEN gone IS NULL THEN w ELSE list_transform(
           list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(gone, j)),
           lambda j: w[j]) END AS kept
  FROM docs LEFT JOIN covered USING (r)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM cut
"""


# CRC-32 of a text's bytes, as a fold over the 256 steps of its polynomial
_CRC32 = """
crc_steps AS (
  SELECT list(v ORDER BY b) AS step FROM (
    SELECT b, list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))
), crc AS (
  SELECT f, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(octet_length(encode(f))),
             lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, step[1 + xor(c & 255, b)]))) AS crc32
  FROM (SELECT DISTINCT f FROM features), crc_steps
)
"""

OP11_IMPORTANCE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, true AS own, text FROM documents
  UNION ALL SELECT NULL, NULL, false, text FROM benchmark
), worded AS (
  SELECT r, doc_id, own, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT r, own, unnest(list_concat(w, list_transform(range(1, len(w)),
           lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM worded
), {crc}, bucketed AS (
  SELECT r, own, CAST(crc32 % 10000 AS BIGINT) AS b FROM features JOIN crc USING (f)
), counted AS (
  SELECT b, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM bucketed GROUP BY b
), gains AS (
  SELECT b, CAST(floor(1000 * ln(
           ((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
           / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counted
), summed AS (
  SELECT r, count(*) AS n_features, sum(gain) AS gain FROM bucketed JOIN gains USING (b)
  WHERE own GROUP BY r
), weighted AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         CAST(coalesce(floor(gain / n_features), 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
              AS BIGINT) AS h
  FROM worded LEFT JOIN summed USING (r) WHERE own
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT)
              AS score,
         n_words >= 20 AS entitled
  FROM weighted
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entitled ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY entitled) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN entitled AND place <= 25 * n // 100 THEN place END AS rank
FROM ranked
""".replace("{crc}", _CRC32.strip())

OP12_LINES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), exploded AS (
  SELECT r, doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM docs
), keyed AS (
  SELECT *, translate(trim(line, E' \t\n\x0B\x0C\r'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM exploded
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM (
  SELECT r, doc_id, i, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN shared USING (k)
) GROUP BY r, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": OP1_TOPK,
        "op4_mixing": OP4_MIXING,
        "op7_repeats": OP7_REPEATS,
        "op11_importance": OP11_IMPORTANCE,
        "op12_lines": OP12_LINES,
    }
