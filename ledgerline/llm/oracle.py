"""DuckDB SQL for the operators that SQL can express, written from their definitions rather than their plans."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def crc_table() -> list[int]:
    """The 256 steps of the reflected CRC-32 polynomial 0xEDB88320."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def _seeded(seed: int, col: str) -> str:
    return f"md5('{seed}:' || coalesce(CAST({col} AS VARCHAR), '?'))"


def _number(digest: str) -> str:
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT)"


def sharding(n_shards: int = 24, seed: int = 17) -> str:
    """Rank in the source by seeded hash, sort by fractional rank, cut by position."""
    return f"""
WITH steps AS (SELECT {crc_table()}::BIGINT[] AS t),
bytes AS (
  SELECT doc_id, source, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS digits,
         strlen(coalesce(text, '')) AS n FROM documents),
lists AS (
  SELECT doc_id, source, n,
         list_transform(range(n), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)) AS b FROM bytes),
sums AS (
  SELECT doc_id, source, CAST(n AS BIGINT) + 8 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                         lambda c, x: xor(c >> 8, steps.t[xor(c, x) % 256 + 1])), 4294967295) AS crc
  FROM lists, steps),
numbered AS (
  SELECT *, coalesce('s' || source, 'n') AS stratum, {_seeded(seed, 'doc_id')} AS h FROM sums),
ranked AS (
  SELECT *, (CAST(row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id NULLS FIRST, size, crc) - 1 AS DOUBLE)
             + {_number(_seeded(seed, 'stratum'))} / CAST(4294967296 AS DOUBLE))
            / CAST(count(*) OVER (PARTITION BY stratum) AS DOUBLE) AS fraction
  FROM numbered),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, h, doc_id NULLS FIRST, size, crc) - 1 AS place,
         count(*) OVER () AS total FROM ranked)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(place * {n_shards} // total AS INTEGER) AS shard,
       CAST(place - ((place * {n_shards} // total) * total + {n_shards - 1}) // {n_shards} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed"""


def mixing(block: int = 16, seed: int = 29, most: int = 3, n_shards: int = 8) -> str:
    """Targets by water level; one row per possible seat, the highest quotients win; ring arithmetic per document.

    A copy's shard: of the seats its source won, in turn, that which holds the copy's first word.
    """
    def covered(ring: str, width: str) -> str:
        return f"({ring} // source_size) * {width} + least({width}, greatest(0, {ring} % source_size - begins))"

    def share(width: str) -> str:
        return (f"CAST(CASE WHEN size = 0 THEN 0 ELSE {covered('ring_to', width)} - ({covered('ring_from', width)}) END"
                f" AS BIGINT)")

    return f"""
WITH docs AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS stratum, CAST({WORDS} AS BIGINT) AS size,
         {_seeded(seed, 'doc_id')} AS h FROM documents),
sources AS (
  SELECT stratum, source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY stratum, source),
weighed AS (
  SELECT *, CAST([5, 2, 1][idx % 3 + 1] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * {most} AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx FROM sources)),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT arg_min(level, [cap / weight, idx]) AS level FROM levels WHERE cap / weight > level),
sized AS (
  SELECT levels.* EXCLUDE (level), CASE WHEN cap / weight <= levels.level THEN cap
         ELSE least(cap, weight * water.level) END AS target
  FROM levels LEFT JOIN water ON true),
seats AS (
  SELECT stratum, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, idx, k) AS turn
  FROM (SELECT stratum, idx, target, unnest(range({most} * source_size // {block})) AS k FROM sized)),
counted AS (SELECT CAST(sum(source_size) // {block} AS BIGINT) AS n FROM sources),
-- The first shard whose seats, of all in turn, reach a seat's turn.
winners AS (
  SELECT stratum, turn, (SELECT min(c) - 1 FROM range(1, {n_shards + 1}) cuts(c) WHERE turn <= n * c // {n_shards}) AS shard,
         row_number() OVER (PARTITION BY stratum ORDER BY turn) - 1 AS place
  FROM seats, counted WHERE turn <= n),
won AS (SELECT stratum, count(*) AS blocks FROM winners GROUP BY stratum),
plan AS (
  SELECT *, ring_from + blocks * {block}
         + least({block - 1}, greatest(0, CAST(floor(target + 1e-6) AS BIGINT) - blocks * {block})) AS ring_to
  FROM (SELECT sized.*, coalesce(blocks, 0) AS blocks,
               ({_number(_seeded(seed, 'sized.stratum'))} % greatest(source_size // {block}, 1)) * {block} AS ring_from
        FROM sized LEFT JOIN won USING (stratum)) p),
placed AS (
  SELECT d.doc_id, d.source, d.stratum, d.size, p.source_size, p.target, p.weight, p.blocks, p.ring_from, p.ring_to,
         sum(d.size) OVER (PARTITION BY d.stratum ORDER BY d.h, d.doc_id NULLS FIRST, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS begins
  FROM docs d JOIN plan p USING (stratum))
SELECT doc_id, source, size, source_size, target, weight, CAST(placed.blocks AS BIGINT) AS blocks,
       {share('size')} AS taken, {share('1')} AS copies,
       CAST(CASE WHEN {share('1')} = 0 THEN NULL ELSE coalesce(winners.shard, {n_shards - 1}) END AS INTEGER) AS first_shard
FROM placed LEFT JOIN winners ON winners.stratum = placed.stratum AND winners.place =
     (begins + CASE WHEN begins < ring_from THEN source_size ELSE 0 END - ring_from) // {block}"""
