"""The registered queries as plain SQL over the driver's tables, written independently of the
DataFrame code: other formulations wherever there is a choice."""

from __future__ import annotations

BLOCKS = """blocks AS (
    SELECT sha256(CAST(event_id AS VARCHAR)) AS hash, ts AS "timestamp",
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS nTx,
           CAST(round(value * 100) AS BIGINT) AS difficulty,
           CAST(event_id AS INTEGER) AS height
    FROM events)"""

MEMPOOL = """mempool AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS txid,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS fee,
           CAST(l_quantity AS BIGINT) * 400 AS weight,
           l_linenumber AS sigops, l_shipdate AS first_seen, l_suppkey AS block, l_linestatus, l_returnflag
    FROM lineitem)"""

TICKER = """ticker AS (SELECT ts AS "timestamp", value AS price FROM events WHERE event_type = 'purchase')"""

SIDES = (
    MEMPOOL
    + """,
actual AS (SELECT block, txid FROM mempool WHERE l_returnflag <> 'N'),
predicted AS (SELECT block, txid FROM mempool WHERE l_linestatus = 'O'),
both_sides AS (
    SELECT coalesce(a.block, p.block) AS block, coalesce(a.txid, p.txid) AS txid,
           CASE WHEN p.txid IS NULL THEN 'added' WHEN a.txid IS NULL THEN 'missing' ELSE 'matches' END AS status,
           coalesce(a.listed, 0) AS listed
    FROM (SELECT block, txid, count(*) AS listed FROM actual GROUP BY ALL) a
    FULL JOIN (SELECT DISTINCT block, txid FROM predicted) p ON a.block = p.block AND a.txid = p.txid)"""
)

SNAPSHOTS = """snapshots AS (
    SELECT 'tx' || user_id AS txid, CAST(round(value * 100) AS BIGINT) AS fee,
           CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) + 1) * 4 AS BIGINT) AS weight,
           CAST(length(event_type) AS INTEGER) AS sigops, ts AS first_seen, event_id AS seq,
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS snapshot
    FROM events)"""

VERSIONS = """versions AS (
    SELECT TIMESTAMP '2024-01-01' + to_days(CAST(user_id % 30 AS INTEGER)) AS "timestamp", CAST(user_id AS VARCHAR) AS hash,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS nTx,
           CAST(round(value * 100) AS BIGINT) AS difficulty, CAST(event_id AS INTEGER) AS height,
           event_id AS seq, event_type <> 'view' AS whole
    FROM events)"""

HEADERS = """headers AS (
    SELECT event_id, sha256(CAST(event_id AS VARCHAR)) AS hash,
           CASE WHEN event_id >= 1 THEN sha256(CAST((event_id - 1) // 2 * 2 AS VARCHAR)) END AS previousblockhash,
           ts AS "timestamp", CAST(round(value * 100) AS BIGINT) AS difficulty,
           CAST((event_id + 1) // 2 AS INTEGER) AS height
    FROM events)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _bucket(width: str, column: str = '"timestamp"') -> str:
    return f"CAST(time_bucket(INTERVAL '{width}', {column}) AS TIMESTAMP)"


def _volume(width: str, alias: str = "time", where: str = "TRUE") -> str:
    return (
        f"SELECT {_bucket(width)} AS {alias}, CAST(sum(nTx) AS BIGINT) AS transactions "
        f"FROM blocks WHERE {where} GROUP BY 1"
    )


def _sigma(totals: str, count: str) -> str:
    """Bands as a table of intervals joined to the totals; the lowest band a total lies in counts."""
    return (
        _with(BLOCKS, f"totals AS ({totals})")
        + f""",
s AS (SELECT avg(transactions) AS m, stddev_samp(transactions) AS d FROM totals),
ends AS (
    SELECT k + 5 - CAST(k > 0 AS INTEGER) AS band, k,
           CASE WHEN k < 0 THEN greatest(0.0, m + k * d) WHEN k = 1 THEN m ELSE m + (k - 1) * d END AS low,
           CASE WHEN k = -1 THEN m WHEN k < 0 THEN m + (k + 1) * d ELSE m + k * d END AS high
    FROM s, (VALUES (-3), (-2), (-1), (1), (2), (3)) AS steps(k)),
bands AS (
    SELECT band, low, high,
           format('{{}}σ [{{}} - {{}}]', printf('%+d', k),
                  CASE WHEN k = -3 THEN '0.00' ELSE printf('%.2f', round(low, 2)) END,
                  printf('%.2f', round(high, 2))) AS label
    FROM ends),
placed AS (
    SELECT t.rowid AS r,
           CASE WHEN t.transactions < s.m - 3 * s.d THEN 1
                ELSE coalesce(min(b.band), CASE WHEN t.transactions > s.m + 3 * s.d THEN 8 END) END AS band
    FROM (SELECT row_number() OVER () AS rowid, transactions FROM totals) t CROSS JOIN s
    LEFT JOIN bands b ON t.transactions BETWEEN b.low AND b.high
    GROUP BY t.rowid, t.transactions, s.m, s.d)
SELECT CASE placed.band WHEN 1 THEN '< 4σ' WHEN 8 THEN '> 4σ' ELSE bands.label END AS stddev_range,
       count(*) AS {count}
FROM placed LEFT JOIN bands ON bands.band = placed.band
GROUP BY 1"""
    )


def _greedy(source: str, weight: int, sigops: int, order: str, by: str = "") -> str:
    """Plain running sums over the whole sorted table."""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    frame = f"({part} ORDER BY fee / weight DESC, {order} ROWS UNBOUNDED PRECEDING)"
    return f"""SELECT {lead}txid, CAST(n - 1 AS INTEGER) AS position, fee, weight, sigops, fee / weight AS fee_rate
FROM (SELECT *, sum(weight) OVER {frame} AS w, sum(sigops) OVER {frame} AS s, row_number() OVER {frame} AS n
      FROM {source})
WHERE w <= {weight} AND s <= {sigops}"""


DAILY = _with(BLOCKS) + _volume("1 day")
IN_RANGE = "BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"
SERIES = (
    _with(BLOCKS)
    + f"SELECT {_bucket('1 day')} AS time, max({{0}}) AS {{0}} FROM blocks GROUP BY 1"
)
SUMMARY = """SELECT block, CAST(count(*) FILTER (WHERE status = 'matches') AS INTEGER) AS matches,
       CAST(count(*) FILTER (WHERE status = 'added') AS INTEGER) AS added,
       CAST(count(*) FILTER (WHERE status = 'missing') AS INTEGER) AS missing,
       round(CASE WHEN sum(listed) > 0 THEN count(*) FILTER (WHERE status = 'matches') / sum(listed)
             ELSE 0 END, 9) AS accuracy
FROM both_sides GROUP BY block"""
TRAIL = (
    "WITH RECURSIVE "
    + HEADERS
    + """,
trail AS (
    SELECT hash, previousblockhash, "timestamp", difficulty, height
    FROM (SELECT * FROM headers ORDER BY height DESC, event_id DESC LIMIT 1)
    UNION ALL
    SELECT h.hash, h.previousblockhash, h."timestamp", h.difficulty, h.height
    FROM trail JOIN headers h ON h.hash = trail.previousblockhash)"""
)
PARTIAL = (
    _with(VERSIONS)
    + """SELECT "timestamp", hash, arg_max_null(nTx, seq) FILTER (WHERE whole) AS nTx,
       arg_max_null(difficulty, seq) AS difficulty, arg_max_null(height, seq) AS height
FROM versions GROUP BY ALL"""
)

ORACLES: dict[str, str] = {
    "daily_transactions": DAILY,
    "daily_height": _with(BLOCKS)
    + "SELECT CAST(date_trunc('day', \"timestamp\") AS TIMESTAMP) AS time, max(height) AS height FROM blocks GROUP BY 1",
    "daily_difficulty": _with(BLOCKS)
    + "SELECT CAST(date_trunc('day', \"timestamp\") AS TIMESTAMP) AS time, max(difficulty) AS difficulty FROM blocks GROUP BY 1",
    "hourly_transactions": _with(BLOCKS) + _volume("1 hour"),
    "five_min_transactions": _with(BLOCKS) + _volume("5 minutes", "bucket"),
    "weekly_transactions": _with(BLOCKS) + _volume("7 days"),
    "daily_from_rollup": DAILY,
    "daily_transactions_range": _with(BLOCKS, f"d AS ({_volume('1 day')})") + f"SELECT * FROM d WHERE time {IN_RANGE}",
    "daily_difficulty_range": _with(BLOCKS)
    + f"""SELECT * FROM (SELECT {_bucket('1 day')} AS time, max(difficulty) AS difficulty FROM blocks GROUP BY 1)
WHERE time {IN_RANGE}""",
    "bucket_stats": _with(BLOCKS, f"totals AS ({_volume('1 hour')})")
    + "SELECT round(avg(transactions), 6) AS mean, round(stddev_samp(transactions), 6) AS stddev FROM totals",
    "sigma_hourly": _sigma(_volume("1 hour"), "hours_in_range"),
    "sigma_daily": _sigma(_volume("1 day"), "days_in_range"),
    "sigma_hourly_range": _sigma(_volume("1 hour", where=f'"timestamp" {IN_RANGE}'), "hours_in_range"),
    "sigma_single_bucket": _sigma(
        "SELECT CAST(sum(nTx) AS BIGINT) AS transactions FROM blocks", "buckets_in_range"
    ),
    "block_height_stat": _with(BLOCKS) + "SELECT max(height) AS height FROM blocks",
    "height_history_and_live": _with(BLOCKS)
    + f"SELECT {_bucket('1 day')} AS time, greatest(max(height), 0) AS height FROM blocks GROUP BY 1",
    "latest_difficulty": _with(BLOCKS)
    + 'SELECT difficulty FROM blocks WHERE "timestamp" = (SELECT max("timestamp") FROM blocks)',
    "latest_blocks": _with(BLOCKS) + "SELECT * FROM blocks ORDER BY height DESC NULLS FIRST LIMIT 10",
    "latest_ticker": _with(TICKER) + 'SELECT * FROM ticker ORDER BY "timestamp" DESC NULLS FIRST LIMIT 10',
    "latest_daily": _with(BLOCKS, f"d AS ({_volume('1 day')})") + "SELECT * FROM d ORDER BY time DESC LIMIT 10",
    "last_not_null": _with(BLOCKS)
    + 'SELECT difficulty FROM blocks WHERE nTx > 20 AND difficulty IS NOT NULL ORDER BY "timestamp" DESC LIMIT 1',
    "fee_rate_ranking": _with(MEMPOOL) + "SELECT txid, fee, weight, fee / weight AS fee_rate, row_number() OVER (ORDER BY fee / weight DESC, txid) AS rank FROM mempool",
    "predict_equal_rates": _with(
        MEMPOOL, "equal AS (SELECT * REPLACE (weight * (1 + sigops % 3) AS fee) FROM mempool)"
    )
    + _greedy("equal", 4_000_000, 80_000, "txid"),
    "predict_equal_rates_sigops": _with(
        MEMPOOL, "equal AS (SELECT * REPLACE (weight * (1 + sigops % 3) AS fee) FROM mempool)"
    )
    + _greedy("equal", 4_000_000, 700, "txid"),
    "predict_block": _with(MEMPOOL) + _greedy("mempool", 4_000_000, 80_000, "txid"),
    "predict_sigops_bound": _with(MEMPOOL) + _greedy("mempool", 4_000_000, 500, "txid"),
    "predict_block_rounds": _with(
        MEMPOOL, "rounds AS (SELECT *, strftime(first_seen, '%Y-%m') AS round FROM mempool)"
    )
    + _greedy("rounds", 400_000, 8_000, "txid", "round"),
    "mempool_latest": _with(SNAPSHOTS)
    + """SELECT l.txid, l.fee, l.weight, l.sigops, l.first_seen, f.first_ever_seen, f.place
FROM (SELECT * FROM snapshots QUALIFY row_number() OVER (PARTITION BY txid ORDER BY seq DESC) = 1) l
JOIN (SELECT txid, min(first_seen) AS first_ever_seen, min(seq) AS place FROM snapshots GROUP BY txid) f
  ON f.txid = l.txid""",
    "mempool_last_snapshot": _with(SNAPSHOTS)
    + "SELECT * FROM snapshots QUALIFY snapshot = max(snapshot) OVER ()",
    "mempool_prune": _with(MEMPOOL)
    + """SELECT txid, fee, weight, sigops FROM mempool m
WHERE NOT EXISTS (SELECT 1 FROM mempool x WHERE x.txid = m.txid AND x.l_returnflag <> 'N')""",
    "predict_from_snapshots": _with(
        SNAPSHOTS,
        """state AS (
    SELECT * EXCLUDE (seq), min(seq) OVER (PARTITION BY txid) AS place FROM snapshots
    QUALIFY row_number() OVER (PARTITION BY txid ORDER BY seq DESC) = 1)""",
    )
    + _greedy("state", 4_000, 80, "place"),
    "audit_matches": _with(SIDES) + "SELECT * FROM actual INTERSECT SELECT * FROM predicted",
    "audit_added": _with(SIDES) + "SELECT * FROM actual EXCEPT SELECT * FROM predicted",
    "audit_missing": _with(SIDES) + "SELECT * FROM predicted EXCEPT SELECT * FROM actual",
    "audit_status": _with(SIDES) + "SELECT block, txid, status, listed FROM both_sides",
    "audit_summary": _with(SIDES)
    + SUMMARY,
    "audit_lists": _with(SIDES)
    + """SELECT block, status, substr(sha256(txid), 1, 1) AS shard, string_agg(txid, ',' ORDER BY txid) AS txids
FROM both_sides GROUP BY 1, 2, 3""",
    "asof_prediction": """SELECT b.event_id AS block, b.ts AS mined_at, p.event_id AS prediction
FROM (SELECT * FROM events WHERE event_type <> 'signup') b
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') p ON b.ts >= p.ts""",
    "audit_rounds": """WITH rows AS (
    SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS block, l_shipdate AS mined_at,
           CAST(l_partkey AS VARCHAR) AS txid, l_linestatus,
           CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS prediction_time
    FROM lineitem),
rounds AS (SELECT DISTINCT prediction_time FROM rows WHERE l_linestatus = 'O'),
pairs AS (
    SELECT r.prediction_time, max(m.block) AS block
    FROM (SELECT DISTINCT block, mined_at FROM rows) m ASOF JOIN rounds r ON m.mined_at >= r.prediction_time
    GROUP BY 1),
a AS (SELECT block, txid, count(*) AS listed FROM rows GROUP BY ALL),
p AS (SELECT DISTINCT pairs.block, txid FROM rows JOIN pairs USING (prediction_time) WHERE l_linestatus = 'O')
SELECT pairs.block, any_value(pairs.prediction_time) AS prediction_time,
       CAST(count(*) FILTER (WHERE x.listed > 0 AND x.foreseen) AS INTEGER) AS matches,
       CAST(count(*) FILTER (WHERE x.listed > 0 AND NOT x.foreseen) AS INTEGER) AS added,
       CAST(count(*) FILTER (WHERE x.listed = 0) AS INTEGER) AS missing,
       round(count(*) FILTER (WHERE x.listed > 0 AND x.foreseen) / sum(x.listed), 9) AS accuracy
FROM pairs JOIN (
    SELECT coalesce(a.block, p.block) AS block, coalesce(a.listed, 0) AS listed, p.txid IS NOT NULL AS foreseen
    FROM a FULL JOIN p ON a.block = p.block AND a.txid = p.txid) x ON x.block = pairs.block
GROUP BY pairs.block""",
    "upsert_full": _with(VERSIONS)
    + """SELECT "timestamp", hash, nTx, difficulty, height FROM versions
QUALIFY row_number() OVER (PARTITION BY "timestamp", hash ORDER BY seq DESC) = 1""",
    "upsert_partial": PARTIAL,
    "upsert_store": PARTIAL,
    "delete_store": _with(MEMPOOL)
    + """SELECT txid, fee, weight, sigops, first_seen FROM mempool
WHERE txid NOT IN (SELECT txid FROM mempool WHERE l_returnflag <> 'N')""",
    "unique_violations": """SELECT l_orderkey, l_linenumber, count(*) AS rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "range_read": _with(BLOCKS) + f'SELECT * FROM blocks WHERE "timestamp" {IN_RANGE}',
    "rollup_realtime": DAILY,
    "rollup_stale": _with(BLOCKS)
    + f"""SELECT {_bucket('1 day')} AS time,
       CAST(sum(nTx + CAST("timestamp" >= TIMESTAMP '2024-01-24' AS INTEGER)) AS BIGINT) AS transactions
FROM blocks GROUP BY 1""",
    "rollup_cascade": _with(BLOCKS)
    + f"""SELECT {_bucket('7 days')} AS time,
       CAST(sum(nTx + CAST("timestamp" >= TIMESTAMP '2024-01-24' AS INTEGER)) AS BIGINT) AS transactions
FROM blocks GROUP BY 1""",
    "stream_daily": DAILY,
    "stream_upsert": PARTIAL,
    "feed_envelopes": _with(BLOCKS) + "SELECT 'blocks_new_row' AS event, * FROM blocks",
    "snapshot_envelopes": _with(BLOCKS, TICKER, f"d AS ({_volume('1 day')})")
    + """SELECT event, CAST(n - 1 AS INTEGER) AS position, time, number FROM (
    SELECT 'blocks_initial_data' AS event, "timestamp" AS time, CAST(height AS DOUBLE) AS number,
           row_number() OVER (ORDER BY height DESC) AS n FROM blocks
    UNION ALL
    SELECT 'transactions_daily_initial_data', time, CAST(transactions AS DOUBLE),
           row_number() OVER (ORDER BY time DESC) FROM d
    UNION ALL
    SELECT 'ticker_price_initial_data', "timestamp", price,
           row_number() OVER (ORDER BY "timestamp" DESC) FROM ticker)
WHERE n <= 10""",
    "chain_walk": TRAIL + 'SELECT hash, "timestamp", difficulty, height FROM trail',
    "canonical_transactions": TRAIL
    + f""",
{BLOCKS}
SELECT CAST(date_trunc('day', b."timestamp") AS TIMESTAMP) AS time, CAST(sum(nTx) AS BIGINT) AS transactions
FROM blocks b JOIN trail ON trail.hash = b.hash GROUP BY 1""",
    "chain_reorg": """SELECT CASE WHEN event_id % 2 = 1 THEN 'leaving' ELSE 'entering' END AS side,
       sha256(CAST(event_id AS VARCHAR)) AS hash, (event_id + 1) // 2 AS height
FROM events WHERE event_id > (SELECT max(event_id) // 4 * 2 FROM events)""",
    "parse_headers": _with(HEADERS)
    + """SELECT hash, date_trunc('second', "timestamp") AS "timestamp", CAST(event_id % 50 AS INTEGER) AS nTx,
       CAST(round(difficulty / 100) AS BIGINT) AS difficulty, height, previousblockhash FROM headers""",
    "blocks_ahead": _with(BLOCKS) + "SELECT * FROM blocks WHERE height >= 100",
    "headers_start": "SELECT CAST(100 AS INTEGER) AS start FROM (SELECT max(event_id) AS top FROM events) WHERE top > 100",
    "parse_numbers": "SELECT event_id, event_id AS number FROM events",
    "lookup_block": _with(BLOCKS) + "SELECT * FROM blocks WHERE height = 77",
    "height_series_today": SERIES.format("height"),
    "saved_prediction_now": _with(MEMPOOL, f"block AS ({_greedy('mempool', 4_000_000, 80_000, 'txid')})")
    + "SELECT txid, position, fee, weight, TRUE AS in_time FROM block",
    "audit_of_nothing": "SELECT CAST(max(event_id) AS INTEGER) AS block_height, 0 AS matches, 0 AS added, 0 AS missing, CAST(0 AS DOUBLE) AS accuracy FROM events",
    "drop_with_rollups": "SELECT count(*) AS rows_before, FALSE AS stored_after, FALSE AS listed_after FROM events",
    "topic_landed": _with(HEADERS)
    + """SELECT hash, date_trunc('second', "timestamp") AS "timestamp", CAST(event_id % 50 AS INTEGER) AS nTx, height FROM headers""",
    "feed_transactions": DAILY.replace("SELECT CAST(time_bucket", "SELECT 'transactions_new_row' AS event, CAST(time_bucket").replace("GROUP BY 1", "GROUP BY 1, 2"),
    "feed_ticker": _with(TICKER) + "SELECT 'ticker_price_new_row' AS event, * FROM ticker",
    "stream_rollup_replay": DAILY,
    "predict_from_store": _with(
        SNAPSHOTS,
        """state AS (
    SELECT * EXCLUDE (seq), min(seq) OVER (PARTITION BY txid) AS place FROM snapshots
    QUALIFY row_number() OVER (PARTITION BY txid ORDER BY seq DESC) = 1)""",
    )
    + _greedy("state", 4_000, 80, "place"),
    "parse_mempool_map": _with(MEMPOOL)
    + """SELECT txid, CAST(trunc(fee / 100 * 100000000) AS BIGINT) AS fee, weight, sigops FROM mempool
UNION ALL
SELECT txid || '-child', CAST(trunc(fee / 100 * 2 * 100000000) AS BIGINT), weight, 0 FROM mempool""",
    "snapshot_days": _with(SNAPSHOTS)
    + "SELECT snapshot, count(*) AS sightings, CAST(sum(weight) AS BIGINT) AS weight FROM snapshots GROUP BY 1",
    "stream_headers": _with(VERSIONS)
    + """SELECT CAST(seq AS VARCHAR) AS hash, TIMESTAMP '2024-01-01' + to_seconds(seq) AS "timestamp",
       CASE WHEN whole THEN nTx END AS nTx, CAST(round(difficulty / 100) AS BIGINT) AS difficulty, height
FROM versions""",
    "stream_mempool": _with(SNAPSHOTS)
    + """SELECT txid, arg_max(fee, seq) AS fee, arg_max(weight, seq) AS weight, arg_max(sigops, seq) AS sigops,
       max(first_seen) AS first_seen FROM snapshots GROUP BY txid""",
    "stream_mempool_mined": _with(SNAPSHOTS)
    + """SELECT txid, arg_max(fee, seq) AS fee, arg_max(weight, seq) AS weight, arg_max(sigops, seq) AS sigops,
       max(first_seen) AS first_seen FROM snapshots
WHERE txid NOT IN (SELECT 'tx' || user_id FROM events WHERE event_type = 'error' AND user_id % 2 = 0) GROUP BY txid""",
    "stream_late": _with(BLOCKS)
    + """, marked AS (
    SELECT *, height % 10 = 0 AND time_bucket(INTERVAL '1 day', "timestamp") + INTERVAL '1 day'
              <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM blocks WHERE height % 10 <> 0) - INTERVAL '3 days' AS behind
    FROM blocks)
SELECT 'bucket' AS kind, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS time, CAST(sum(nTx) AS BIGINT) AS total, count(*) AS rows
FROM marked WHERE NOT behind GROUP BY 2
UNION ALL SELECT 'late', "timestamp", nTx, 1 FROM marked WHERE behind""",
    "feed_changes": _with(BLOCKS) + "SELECT 'blocks_new_row' AS event, * FROM blocks",
    "stream_ticker": _with(TICKER) + "SELECT * FROM ticker",
    "saved_prediction": _with(MEMPOOL, f"block AS ({_greedy('mempool', 4_000_000, 80_000, 'txid')})")
    + "SELECT TIMESTAMP '2024-01-05' AS prediction_time, txid, position, fee, weight FROM block",
    "saved_audits": _with(SIDES, f"summary AS ({SUMMARY})")
    + """SELECT CAST(block AS INTEGER) AS block_height, TIMESTAMP '2024-01-05' AS audit_time,
       matches, added, missing, accuracy FROM summary""",
    "panel_transactions_daily": DAILY,
    "panel_transactions_daily_range": _with(BLOCKS, f"d AS ({_volume('1 day')})")
    + f"SELECT * FROM d WHERE time {IN_RANGE}",
    "panel_sigma_hourly": _sigma(_volume("1 hour", where=f'"timestamp" {IN_RANGE}'), "hours_in_range"),
    "panel_sigma_daily": _sigma(_volume("1 day"), "days_in_range"),
    "panel_sql_text": _with(BLOCKS) + _volume("1 hour", where=f'"timestamp" {IN_RANGE}'),
    "panel_block_height": _with(BLOCKS) + "SELECT max(height) AS height FROM blocks",
    "panel_block_height_daily": SERIES.format("height"),
    "panel_block_difficulty": _with(BLOCKS)
    + 'SELECT arg_max(difficulty, "timestamp") AS difficulty FROM blocks',
    "panel_block_difficulty_daily": SERIES.format("difficulty"),
}

ORACLES["stream_cycle"] = ORACLES["audit_rounds"]
