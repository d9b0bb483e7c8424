"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from txnlab.llm import mixing

ORACLE_SQL: dict[str, str] = {}


def _apportion(units: str, group: str, unit: str, weight: str, seats: str, out: str) -> str:
    """Common table expressions ending in ``out``: ``units`` with a quota."""
    return f"""
{out}_u AS (
  SELECT *, CAST(floor({seats} * sh + 0.5e0) AS BIGINT) AS base FROM (
    SELECT *, CASE WHEN sum({weight}) OVER (PARTITION BY {group}) > 0
                   THEN {weight} / sum({weight}) OVER (PARTITION BY {group}) ELSE 0e0 END AS sh,
           sum({weight}) OVER (PARTITION BY {group}) AS al, count(*) OVER (PARTITION BY {group}) AS cnt
    FROM {units})),
{out}_s AS (
  SELECT *, CASE WHEN al > 0 THEN {seats} ELSE 0 END - sum(base) OVER (PARTITION BY {group}) AS short FROM {out}_u),
{out}_q AS (
  SELECT {group}, {unit}, short, row_number() OVER (PARTITION BY {group} ORDER BY
           CASE WHEN short > 0 THEN -q ELSE q END, {unit} NULLS LAST, j) AS r
  FROM (SELECT *, {weight} / CASE WHEN short > 0 THEN 2 * (base + j) - 1 ELSE 2 * (base - j) + 1 END AS q
        FROM (SELECT *, unnest(range(1, CAST(ceil(sh * (abs(short) + cnt)) AS BIGINT) + 2)) AS j FROM {out}_s
              WHERE short <> 0 AND {weight} > 0)
        WHERE short > 0 OR j <= base)),
{out}_c AS (
  SELECT {group} AS g_, {unit} AS u_, sum(CASE WHEN short > 0 THEN 1 ELSE -1 END) AS ch
  FROM {out}_q WHERE r <= abs(short) GROUP BY ALL),
{out} AS (
  SELECT s.*, CAST(base + coalesce(ch, 0) AS BIGINT) AS quota FROM {out}_s s
  LEFT JOIN {out}_c c ON s.{group} IS NOT DISTINCT FROM c.g_ AND s.{unit} IS NOT DISTINCT FROM c.u_)"""


def _mix_sql() -> str:
    b, sw, ep = mixing.BLOCK_WORDS, mixing.SHARD_WORDS, mixing.EPOCHS
    w = mixing.WEIGHTS
    num, den = mixing.BUDGET
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce('s' || source, 'z') AS src, md5('{mixing.SEED}|' || CAST(doc_id AS VARCHAR)) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS BIGINT) AS size FROM documents),
src AS (
  SELECT src, source_size, CAST(source_size AS HUGEINT) * {ep} AS cap,
         CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN {w[0]} WHEN 1 THEN {w[1]} ELSE {w[2]} END AS w
  FROM (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY src)),
lev AS (SELECT *, cap * ({w[0] * w[1] * w[2]} // w) AS level, sum(source_size) OVER () AS total FROM src),
cum AS (
  SELECT *, sum(cap) OVER (ORDER BY level RANGE UNBOUNDED PRECEDING) AS caps,
         sum(w) OVER () - sum(w) OVER (ORDER BY level RANGE UNBOUNDED PRECEDING) AS above FROM lev),
capped AS (SELECT *, (caps * w + cap * above) * {den} <= total * {num} * w AS full_ FROM cum),
tg AS (
  SELECT src, source_size, 0 AS one,
         CASE WHEN full_ THEN CAST(cap AS DOUBLE) ELSE
           (CAST(total * {num} AS DOUBLE) / {den}e0 - CAST(coalesce(sum(CASE WHEN full_ THEN cap END) OVER (), 0) AS DOUBLE))
           * w / CAST(sum(CASE WHEN NOT full_ THEN w END) OVER () AS DOUBLE) END AS target FROM capped),
tb AS (SELECT *, CAST(round(sum(target) OVER () / {b}) AS BIGINT) AS blocks FROM tg),
{_apportion("tb", "one", "src", "target", "blocks", "bs")},
source_quota AS (
  SELECT src, source_size, target, quota AS source_blocks,
         greatest(1, CAST(ceil(source_size / {sw}e0) AS BIGINT)) AS n_shards FROM bs),
placed AS (
  SELECT d.*, q.source_size, q.target, q.source_blocks, CAST('0x' || substr(h, 1, 8) AS BIGINT) % n_shards AS shard
  FROM sized d JOIN source_quota q USING (src)),
sh0 AS (
  SELECT src, shard, CAST(sum(size) AS BIGINT) AS shard_size, max(source_blocks) AS source_blocks
  FROM placed GROUP BY src, shard),
{_apportion("sh0", "src", "shard", "shard_size", "source_blocks", "sq")},
shard_words AS (SELECT src, shard, shard_size, least(quota * {b}, shard_size * {ep}) AS words FROM sq),
tape AS (
  SELECT p.*, s.shard_size, s.words, sum(size) OVER (PARTITION BY p.src, p.shard ORDER BY h NULLS FIRST, doc_id NULLS LAST, size
           ROWS UNBOUNDED PRECEDING) - size AS before_
  FROM placed p JOIN shard_words s ON p.src = s.src AND p.shard = s.shard)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN shard_size > 0 THEN (words // shard_size) * size
            + greatest(0, least(size, words % shard_size - before_)) ELSE 0 END AS BIGINT) AS taken
FROM tape"""


ORACLE_SQL["op5_mix_sources"] = _mix_sql()


def _audit_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{word}') AS w, min(doc_id) OVER (PARTITION BY t) AS first_ FROM d),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(w.doc_id > first_, FALSE) THEN 16 ELSE 0 END AS fails
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id),
p AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS mask
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN fails & (mask | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & mask = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & mask > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & mask = 0 AND fails & bit > 0 THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & mask = 0 AND fails & bit > 0 THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM p, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""


ORACLE_SQL["op11_filter_audit"] = _audit_sql()
