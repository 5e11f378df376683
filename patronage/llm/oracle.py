"""SQL for the operators that SQL can express, to check whole results in a second engine."""

ORACLE: dict[str, str] = {}

ORACLE["op6_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
),
stops AS (SELECT *, source_size * 2.0::DOUBLE AS stop FROM weighed),
levels AS (
  SELECT *,
    (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM stops
),
targets AS (
  SELECT source, source_size,
    coalesce(least(stop, weight * max(CASE WHEN level <= stop / weight THEN level END) OVER ()), stop) AS target
  FROM levels
),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes,
    greatest(1, ceil(source_size / 1000000))::BIGINT AS shards
  FROM targets
),
wanted AS (SELECT *, target - passes * source_size AS wanted FROM passes),
seats AS (SELECT *, round(sum(wanted) OVER () / 128)::BIGINT AS seats FROM wanted),
quotients AS (
  SELECT source, wanted / (2 * k + 1) AS quotient, seats
  FROM seats, range(0, (SELECT max(ceil(wanted / 128))::BIGINT + (SELECT count(*) FROM seats) + 2 FROM seats)) t(k)
  WHERE wanted > 0 AND k <= wanted / 128 + (SELECT count(*) FROM seats) + 1
),
won AS (
  SELECT source, count(*) AS blocks
  FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS place FROM quotients)
  WHERE place <= seats GROUP BY source
),
quotas AS (
  SELECT s.*, coalesce(blocks, 0) AS blocks FROM seats s LEFT JOIN won w ON s.source IS NOT DISTINCT FROM w.source
),
placed AS (
  SELECT d.doc_id, d.source, d.size, q.source_size, q.target, q.passes, q.blocks,
    md5(concat_ws(':', '17', coalesce(d.doc_id::VARCHAR, ''))) AS digest,
    ('0x' || substr(md5(concat_ws(':', '17', coalesce(d.doc_id::VARCHAR, ''))), 1, 8))::BIGINT % q.shards AS shard
  FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
),
shards AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM placed GROUP BY ALL
),
shard_quotients AS (
  SELECT source, shard, blocks, shard_size / (2 * k + 1) AS quotient
  FROM shards, range(0, (SELECT max(ceil(shard_size / 128))::BIGINT + 2 FROM shards)) t(k)
  WHERE shard_size > 0 AND k <= shard_size / 128 + 1
),
shard_won AS (
  SELECT source, shard, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) AS place FROM shard_quotients)
  WHERE place <= blocks GROUP BY ALL
),
chosen AS (
  SELECT s.source, s.shard, least(coalesce(w.quota, 0), ceil(s.shard_size / 128)::BIGINT) AS m,
    greatest(ceil(s.shard_size / 128)::BIGINT, 1) AS n,
    ('0x' || substr(md5(concat_ws(':', '17', 'start', coalesce(s.source, ''), s.shard::VARCHAR)), 1, 8))::BIGINT
      % greatest(ceil(s.shard_size / 128)::BIGINT, 1) AS r
  FROM shards s LEFT JOIN shard_won w ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard
),
streams AS (
  SELECT p.*, c.m, c.n, c.r,
    coalesce(sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.digest, p.doc_id, p.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM placed p JOIN chosen c ON p.source IS NOT DISTINCT FROM c.source AND p.shard = c.shard
),
edges AS (
  SELECT *, begin // 128 AS b0, begin % 128 AS o0, (begin + size) // 128 AS b1, (begin + size) % 128 AS o1 FROM streams
)
SELECT doc_id, size, source_size, target,
  (passes * size + CASE WHEN size > 0 THEN
      (floor((b1 - 1 + r) * m / n) - floor((b0 - 1 + r) * m / n)) * 128
      + o1 * (CASE WHEN ((b1 + r) * m) % n < m THEN 1 ELSE 0 END)
      - o0 * (CASE WHEN ((b0 + r) * m) % n < m THEN 1 ELSE 0 END)
    ELSE 0 END)::BIGINT AS taken
FROM edges
"""
