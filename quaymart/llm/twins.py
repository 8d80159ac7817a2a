"""DuckDB twins of those queries whose result plain SQL can express."""

from __future__ import annotations

from quaymart.llm.resampling import BUCKETS, LEAST_WORDS, LONGEST, PERCENT, SEED, crc_table

_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = " || ".join(
    f"list_transform(range(1, len(w) - {n - 1} + 1), lambda i: array_to_string(w[i:i + {n - 1}], ' '))" for n in range(1, LONGEST + 1))
# crc32 by half bytes, the lower one first, with the 16 entries that the polynomial gives.
_HALVES = crc_table()[::16].tolist()
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h)), lambda i: instr('0123456789ABCDEF', h[xor(i, 1) + 1]) - 1)),
    lambda c, b: xor(c >> 4, ([{', '.join(map(str, _HALVES))}]::BIGINT[])[(xor(c, b) & 15) + 1])), 4294967295)"""

RESAMPLE_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, true AS doc, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents
  UNION ALL SELECT -row_number() OVER (), false, NULL, regexp_extract_all({_LOWER}, '{_WORDS}') FROM benchmark),
found AS (SELECT r, doc, unnest({_RUNS}) AS f FROM texts),
bytes AS MATERIALIZED (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM found)),
hashed AS (SELECT f, ({_CRC}) % {BUCKETS} AS bucket FROM bytes),
met AS (SELECT r, doc, bucket, count(*) AS n FROM found JOIN hashed USING (f) GROUP BY ALL),
counts AS (SELECT bucket, coalesce(sum(n) FILTER (doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT doc), 0)::DOUBLE AS t FROM met GROUP BY 1),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + {BUCKETS})
    / ((s + 1) * ((SELECT sum(t) FROM counts) + {BUCKETS}))))::BIGINT AS gain FROM counts),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM met JOIN gains USING (bucket) WHERE doc GROUP BY 1),
scored AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE doc),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= {LEAST_WORDS} AND score IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)"""

NEGATIVES_SQL = """
WITH rows AS (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5"""
