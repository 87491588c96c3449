"""DuckDB SQL for every registered query, over the same parquet tables.

The CTEs restate the fixture mapping of ``tapehouse.plans.fixtures`` in
plain SQL; the final SELECTs state each operator's semantics directly
(windows, arg_min/arg_max, anti-joins), independent of the Spark code.
"""

from __future__ import annotations

from tapehouse.plans.fixtures import MIXED_TYPE_SQL

TRADES = """trades AS (
  SELECT event_id AS trade_id, event_id AS sequence, event_type AS product_id,
         value AS price, CAST(event_id % 10 + 1 AS DOUBLE) AS size,
         CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         ts AS time, ts AS ingest_time
  FROM events)"""


def _bars(unit: str, name: str = "bars", rounded: bool = False) -> str:
    vwap = "sum(price * size) / nullif(sum(size), 0)"
    if rounded:
        vwap = f"round({vwap}, 10)"
    return f"""{name} AS (
  SELECT product_id, date_trunc('{unit}', time) AS bucket,
         arg_min(price, (time, trade_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (time, trade_id)) AS close, sum(size) AS volume,
         {vwap} AS vwap, count(*) AS trade_count
  FROM trades GROUP BY product_id, date_trunc('{unit}', time))"""


BOOK = """book AS (
  SELECT event_id AS msg_offset, ts AS ingest_time,
         CASE WHEN event_id % 50 = 0 THEN 'snapshot' ELSE 'l2update' END AS type,
         'P' || CAST(user_id % 5 AS VARCHAR) AS product_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'buy' ELSE 'sell' END AS side,
         round(value, 0) AS price, CAST(event_id % 4 AS DOUBLE) AS size,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id END AS sequence,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS time
  FROM events)"""

LEVELS = """levels AS (
  SELECT product_id, side, price, size, ingest_time AS event_time, sequence, ingest_time
  FROM book)"""


def _latest(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT product_id, side, price, size, event_time, sequence FROM (
    SELECT *, row_number() OVER (
      PARTITION BY product_id, side, price
      ORDER BY event_time DESC NULLS LAST, sequence DESC NULLS LAST, size DESC NULLS LAST) AS rn
    FROM levels WHERE {where}) WHERE rn = 1)"""


def _anti_union(target: str, source: str, keys: list[str]) -> str:
    on = " AND ".join(f"s.{k} = {target}.{k}" for k in keys)
    return (
        f"SELECT * FROM {target} WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {on}) "
        f"UNION ALL SELECT * FROM {source}"
    )


LEVEL_KEYS = ["product_id", "side", "price"]
BAR_COLS = "product_id, bucket, open, high, low, close, volume, round(vwap, 10) AS vwap, trade_count"

LADDER = """ladder AS (
  SELECT product_id, side, level, price, size FROM (
    SELECT *, row_number() OVER (
      PARTITION BY product_id, side
      ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END ASC NULLS LAST,
               size DESC NULLS LAST) AS level
    FROM latest WHERE size > 0 AND side IN ('buy', 'sell')) WHERE level <= 10)"""


def _resample(width: str) -> str:
    return f"""WITH {TRADES}, {_bars('minute')}
SELECT product_id, time_bucket(INTERVAL {width}, bucket) AS bucket,
       arg_min(open, bucket) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, bucket) AS close, sum(volume) AS volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count,
       round(sum(vwap * volume) / nullif(sum(volume), 0), 10) AS vwap
FROM bars GROUP BY product_id, time_bucket(INTERVAL {width}, bucket)"""


def _gaps(src: str, part: list[str], order: list[str], seq: str = "sequence") -> str:
    p = ", ".join(part)
    o = ", ".join(order)
    return f"""SELECT {p}, {o}, {seq}, prev + 1 AS expected, {seq} - prev - 1 AS missing FROM (
  SELECT {p}, {o}, {seq}, lag({seq}) OVER (PARTITION BY {p} ORDER BY {o}) AS prev
  FROM {src} WHERE product_id IS NOT NULL AND {seq} IS NOT NULL)
WHERE {seq} > prev + 1"""


MIXED = f"""mixed AS (
  SELECT event_id AS msg_offset, {MIXED_TYPE_SQL} AS type FROM events)"""

RB = """rb AS (
  SELECT event_id AS e, user_id AS u, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS ingest_time,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + INTERVAL (event_id % 3) MINUTE END AS sent,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'P' || CAST(user_id % 5 AS VARCHAR) END AS product_id,
         CAST(round(value, 0) AS BIGINT) AS base, event_id % 50 = 0 AS snap
  FROM events),
rc AS (SELECT *, CASE WHEN sent IS NULL THEN 'nope' ELSE strftime(sent, '%Y-%m-%dT%H:%M:%S.%fZ') END AS time FROM rb)"""
RL = RB + """,
entries AS (
  SELECT *, 'buy' AS side FROM rc, range(1, 5) r(i) WHERE snap AND i <= u % 4
  UNION ALL SELECT *, 'sell' AS side FROM rc, range(1, 5) r(i) WHERE snap AND i <= u % 3
  UNION ALL SELECT *, CASE WHEN (e + i) % 2 = 0 THEN 'buy' ELSE 'sell' END AS side
  FROM rc, range(1, 5) r(i) WHERE NOT snap AND e % 29 <> 0 AND i <= e % 5),
levels AS (
  SELECT product_id, side, CASE WHEN (e + i) % 37 = 0 THEN NULL ELSE CAST(base + i AS DOUBLE) END AS price,
         CASE WHEN (e + i) % 31 = 0 THEN NULL ELSE CAST((e + i) % 4 AS DOUBLE) END AS size,
         CASE WHEN snap THEN ingest_time ELSE coalesce(sent, ingest_time) END AS event_time,
         CASE WHEN snap THEN NULL ELSE e END AS sequence, ingest_time
  FROM entries)"""
# The same without messages that arrived before their product's newest snapshot.
FRESH = """,
newest AS (SELECT product_id, max(struct_pack(t := ingest_time, o := e)) AS at FROM rc WHERE snap GROUP BY product_id)"""
SINCE = """FROM entries n WHERE NOT EXISTS (
    SELECT 1 FROM newest s WHERE s.product_id IS NOT DISTINCT FROM n.product_id
    AND struct_pack(t := n.ingest_time, o := n.e) < s.at))"""


def _reset(snapshot_time: str) -> str:
    levels = RL[RL.index("levels AS ("):].replace("FROM entries)", SINCE)
    levels = levels.replace("CASE WHEN snap THEN ingest_time", f"CASE WHEN snap THEN {snapshot_time}")
    return f"WITH {RL[:RL.index('levels AS (')].rstrip().rstrip(',')}{FRESH},\n{levels}, {_latest('latest')} SELECT * FROM latest"



def _entry(side: str) -> str:
    return f"""'[' || {side} || '"' || CASE WHEN (e + i) % 37 = 0 THEN 'abc' ELSE CAST(base + i AS VARCHAR) END || '"'
      || CASE WHEN (e + i) % 31 = 0 THEN '' ELSE ',"' || CAST((e + i) % 4 AS VARCHAR) || '"' END || ']'"""


def _entries(n: str, side: str) -> str:
    return f"array_to_string(list_transform(range(1, least({n}, 4) + 1), lambda i: {_entry(side)}), ',')"


def _rt(corrected: bool = False) -> str:
    sends = "VALUES (0, 0), (1, 0), (2, 1)" if corrected else "VALUES (0, 0), (1, 0)"
    return f"""rt AS (
  SELECT CASE WHEN event_id % 23 = 0 THEN NULL ELSE event_id END AS trade_id, event_id + added AS sequence,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type END AS product_id,
         CAST(CAST(round(value, 0) AS BIGINT) + added AS DOUBLE) AS price, CAST(event_id % 2 AS DOUBLE) AS size,
         'buy' AS side, CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts + INTERVAL (days) DAY END AS time,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE + INTERVAL (days * 40) DAY AS ingest_time,
         event_id AS msg_offset, event_type, value, added
  FROM events, ({sends}) sends(added, days)
  WHERE added = 0 OR (added = 1 AND event_id % 5 = 0) OR (added = 2 AND event_id % 11 = 0)),
clean AS (
  SELECT trade_id, sequence, product_id, price, size, side, time, ingest_time FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC, sequence DESC) AS rn
    FROM rt WHERE trade_id IS NOT NULL AND product_id IS NOT NULL AND time IS NOT NULL)
  WHERE rn = 1)"""


ROUTE = (
    "CASE WHEN type IN ('snapshot', 'l2update') THEN 'orderbook' "
    "WHEN type IN ('match', 'last_match') THEN 'trades' END"
)

ORACLE_SQL: dict[str, str] = {
    "ohlcv_1min": f"WITH {TRADES}, {_bars('minute')} SELECT {BAR_COLS} FROM bars",
    "ohlcv_1h": f"WITH {TRADES}, {_bars('hour')} SELECT {BAR_COLS} FROM bars",
    "ohlcv_1d": """WITH t AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 3 = 0 THEN -event_id
              ELSE event_id + 4000000000000000000 END AS trade_id,
         event_type AS product_id, value AS price, CAST(event_id % 10 + 1 AS DOUBLE) AS size,
         CASE WHEN event_id % 97 = 0 THEN ts ELSE date_trunc('hour', ts) END AS time
  FROM events),
k AS (SELECT *, coalesce(trade_id, -9223372036854775807 - 1) AS id FROM t)
SELECT product_id, CAST(date_trunc('day', time) AS TIMESTAMP) AS bucket, arg_min(price, (time, id)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (time, id)) AS close, sum(size) AS volume,
       round(sum(price * size) / nullif(sum(size), 0), 10) AS vwap, count(*) AS trade_count
FROM k GROUP BY product_id, date_trunc('day', time)""",
    "ohlcv_resample_1h": _resample("1 HOUR"),
    "ohlcv_resample_2h": _resample("2 HOUR"),
    "last_bars": f"""WITH {TRADES}, {_bars('minute')}
SELECT {BAR_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY bucket DESC) AS rn FROM bars)
WHERE rn <= 100""",
    "bar_direction": f"""WITH {TRADES}, {_bars('minute')}
SELECT product_id, bucket, open, close,
       CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction FROM bars""",
    "chart_bars": f"""WITH {TRADES}, {_bars('minute')},
c AS (SELECT max(bucket) - INTERVAL '7200' MINUTE AS since FROM bars),
h AS (
  SELECT product_id, time_bucket(INTERVAL 1 HOUR, bucket) AS bucket,
         arg_min(open, bucket) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, bucket) AS close, sum(volume) AS volume,
         CAST(sum(trade_count) AS BIGINT) AS trade_count,
         round(sum(vwap * volume) / nullif(sum(volume), 0), 10) AS vwap
  FROM bars, c WHERE bucket >= since
  GROUP BY product_id, time_bucket(INTERVAL 1 HOUR, bucket))
SELECT product_id, bucket, open, high, low, close, volume, trade_count, vwap,
       CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY bucket DESC) AS rn FROM h)
WHERE rn <= 100""",
    "ticker_24h": f"""WITH {TRADES}, {_bars('minute')},
a AS (SELECT max(bucket) AS asof_ts FROM bars),
t AS (
  SELECT product_id, arg_max(close, bucket) AS last_price, arg_min(close, bucket) AS first_close,
         max(high) AS high_24h, min(low) AS low_24h, sum(volume) AS volume_24h
  FROM bars, a WHERE bucket >= asof_ts - INTERVAL '24' HOUR GROUP BY product_id)
SELECT *, CASE WHEN first_close = 0 THEN 0.0
               ELSE (last_price - first_close) / first_close * 100.0 END AS change_pct FROM t""",
    "recent_trades": f"""WITH {TRADES},
c AS (SELECT max(time) - INTERVAL '7200' MINUTE AS since FROM trades)
SELECT product_id, time, side, price, size, trade_id FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY time DESC, trade_id DESC) AS rn
  FROM trades, c WHERE time >= since)
WHERE rn <= 30""",
    "trade_parse": f"WITH {TRADES} SELECT * FROM trades",
    "parse_malformed": """SELECT event_id AS msg_offset,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_id END AS trade_id,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS product_id,
  CASE WHEN event_id % 19 = 0 OR event_id % 13 = 0 THEN NULL ELSE value END AS price,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(event_id % 10 + 1 AS DOUBLE) END AS size,
  CASE WHEN event_id % 19 = 0 OR event_id % 17 = 0 THEN NULL ELSE ts END AS time,
  ts AS event_time
FROM events""",
    "trades_dedup": f"""WITH {TRADES},
feed AS (
  SELECT * FROM trades
  UNION ALL
  SELECT trade_id, sequence, product_id, price, size, side, time,
         ingest_time + INTERVAL '1' HOUR AS ingest_time
  FROM trades WHERE minute(time) < 6)
SELECT trade_id, sequence, product_id, price, size, side, time, ingest_time FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC) AS rn
  FROM feed WHERE trade_id IS NOT NULL AND product_id IS NOT NULL AND time IS NOT NULL)
WHERE rn = 1""",
    "trades_incremental": f"""WITH {TRADES}
SELECT * FROM trades
WHERE ingest_time > (
  SELECT coalesce(max(ingest_time), TIMESTAMP '1970-01-01') FROM trades
  WHERE ingest_time < TIMESTAMP '2024-01-16')""",
    "trades_upsert": f"""WITH {TRADES},
tgt AS (SELECT * FROM trades WHERE time < TIMESTAMP '2024-01-19'),
src AS (SELECT trade_id, sequence, product_id, price + 1 AS price, size, side, time, ingest_time
        FROM trades WHERE time >= TIMESTAMP '2024-01-16')
{_anti_union('tgt', 'src', ['trade_id'])}""",
    "envelope_parse": f"""WITH {BOOK}
SELECT type, product_id, time, sequence, ingest_time, msg_offset FROM book""",
    "levels_flatten": f"""WITH {BOOK}
SELECT product_id, side, price, size, ingest_time AS event_time, sequence FROM book""",
    "levels_latest": f"WITH {BOOK}, {LEVELS}, {_latest('latest')} SELECT * FROM latest",
    "levels_incremental": f"""WITH {BOOK}, {LEVELS},
{_latest('first_run', "ingest_time < TIMESTAMP '2024-01-16'")},
{_latest('second_run', "ingest_time > (SELECT coalesce(max(event_time), TIMESTAMP '1970-01-01') FROM first_run)")}
{_anti_union('first_run', 'second_run', LEVEL_KEYS)}""",
    "levels_upsert": f"""WITH {BOOK}, {LEVELS},
{_latest('tgt', "ingest_time < TIMESTAMP '2024-01-16'")},
{_latest('src', "ingest_time >= TIMESTAMP '2024-01-12'")}
{_anti_union('tgt', 'src', LEVEL_KEYS)}""",
    "levels_upsert_guarded": f"""WITH {BOOK}, {LEVELS},
{_latest('tgt')},
{_latest('late', "ingest_time >= TIMESTAMP '2024-01-05' AND ingest_time < TIMESTAMP '2024-01-12'")},
u AS (SELECT *, 0 AS src FROM tgt UNION ALL SELECT *, 1 AS src FROM late)
SELECT product_id, side, price, size, event_time, sequence FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id, side, price
                               ORDER BY event_time DESC NULLS LAST, sequence DESC NULLS LAST, src DESC) AS rn
  FROM u) WHERE rn = 1""",
    "levels_upsert_delete_removed": f"""WITH {BOOK}, {LEVELS},
{_latest('tgt', "ingest_time < TIMESTAMP '2024-01-16'")},
{_latest('src', "ingest_time >= TIMESTAMP '2024-01-12'")},
m AS ({_anti_union('tgt', 'src', LEVEL_KEYS)})
SELECT * FROM m WHERE NOT coalesce(size = 0, FALSE)""",
    "levels_reset_on_snapshot": f"""WITH {BOOK}, {LEVELS}, {_latest('latest')},
last_snapshot AS (SELECT product_id, max(ingest_time) AS snap_time FROM book WHERE type = 'snapshot' GROUP BY product_id)
SELECT l.* FROM latest l LEFT JOIN last_snapshot s ON l.product_id = s.product_id
WHERE s.snap_time IS NULL OR l.event_time >= s.snap_time""",
    "top_of_book": f"""WITH {BOOK}, {LEVELS}, {_latest('latest')},
per_product AS (
  SELECT product_id, max(CASE WHEN side = 'buy' THEN price END) AS best_bid,
         min(CASE WHEN side = 'sell' THEN price END) AS best_ask
  FROM latest WHERE size > 0 GROUP BY product_id)
SELECT product_id, best_bid, best_ask, best_ask - best_bid AS spread FROM per_product""",
    "ladder": f"WITH {BOOK}, {LEVELS}, {_latest('latest')}, {LADDER} SELECT * FROM ladder",
    "ladder_spread": f"""WITH {BOOK}, {LEVELS}, {_latest('latest')}, {LADDER}
SELECT product_id,
       max(CASE WHEN side = 'sell' THEN price END) - max(CASE WHEN side = 'buy' THEN price END) AS spread
FROM ladder WHERE level = 1 GROUP BY product_id""",
    "sequence_gaps": f"WITH {TRADES} " + _gaps("trades", ["product_id"], ["time", "trade_id"]),
    "sequence_gaps_by_session": (BY_SESSION := f"""WITH {BOOK},
s AS (
  SELECT product_id, sequence, ingest_time, msg_offset,
         CAST(sum(CASE WHEN type = 'snapshot' THEN 1 ELSE 0 END) OVER (
           PARTITION BY product_id ORDER BY ingest_time, msg_offset
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
  FROM book)
""" + _gaps("s", ["product_id", "session_id"], ["ingest_time", "msg_offset"])),
    "stream_sequence_gaps": BY_SESSION,
    "session_numbers": f"""WITH {BOOK}
SELECT type, product_id, ingest_time, msg_offset,
       CAST(sum(CASE WHEN type = 'snapshot' THEN 1 ELSE 0 END) OVER (
         PARTITION BY product_id ORDER BY ingest_time, msg_offset
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
FROM book""",
    "sequence_gaps_backfill": f"""WITH {TRADES},
b AS (SELECT * REPLACE (CAST(date_trunc('year', ingest_time) AS TIMESTAMP) AS ingest_time) FROM trades)
""" + _gaps("b", ["product_id"], ["ingest_time", "trade_id"]),
    "feed_sequence_gaps": f"""WITH m AS (
  SELECT event_id AS msg_offset, ts AS ingest_time, {MIXED_TYPE_SQL} AS type,
         event_type AS product_any, event_id AS sequence FROM events),
s AS (
  SELECT msg_offset, ingest_time, type, sequence,
         CASE WHEN type <> 'subscriptions' THEN product_any END AS product_id,
         CAST(sum(CASE WHEN type = 'subscriptions' THEN 1 ELSE 0 END) OVER (
           ORDER BY ingest_time, msg_offset
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
  FROM m),
g AS (SELECT * FROM s WHERE type IN ('heartbeat', 'snapshot', 'l2update'))
""" + _gaps("g", ["product_id", "session_id"], ["ingest_time", "msg_offset"]),
    "feed_routing": f"WITH {MIXED} SELECT msg_offset, type, {ROUTE} AS route FROM mixed",
    "feed_split": f"""WITH {MIXED}
SELECT msg_offset, {ROUTE} AS route FROM mixed WHERE {ROUTE} IS NOT NULL""",
    "message_counts": f"WITH {MIXED} SELECT type, count(*) AS messages FROM mixed GROUP BY type",
    "stream_bronze_trades": f"""WITH {TRADES}
SELECT trade_id, sequence, product_id, price, size, side, time FROM trades""",
    "stream_bronze_orderbook": f"WITH {BOOK} SELECT type, product_id, time, sequence FROM book",
    "day_partition_roundtrip": f"""WITH {TRADES}
SELECT *, CAST(time AS DATE) AS time_date FROM trades""",
    "full_refresh_roundtrip": f"WITH {TRADES}, {_bars('minute')} SELECT {BAR_COLS} FROM bars",
    "publish_records": f"""WITH {TRADES}
SELECT coalesce(product_id, 'unknown') AS key, trade_id, price, size, side, time FROM trades""",
    "rough_envelope_parse": f"""WITH {RB}
SELECT CASE WHEN snap THEN 'snapshot' ELSE 'l2update' END AS type, product_id, time,
       CASE WHEN snap THEN NULL ELSE e END AS sequence,
       '{{"type":"' || CASE WHEN snap THEN 'snapshot' ELSE 'l2update' END || '","product_id":'
         || coalesce('"' || product_id || '"', 'null') || ',"time":"' || time || '",'
         || CASE WHEN snap
              THEN '"bids":[' || {_entries('u % 4', "''")} || '],"asks":[' || {_entries('u % 3', "''")} || ']'
              ELSE '"sequence":' || CAST(e AS VARCHAR) || CASE WHEN e % 29 = 0 THEN '' ELSE ',"changes":['
                || {_entries('e % 5', "CASE WHEN (e + i) % 2 = 0 THEN '\"buy\",' ELSE '\"sell\",' END")} || ']' END
            END || '}}' AS payload,
       ingest_time, e AS msg_offset
FROM rc""",
    "rough_trade_parse": f"""WITH {_rt()}
SELECT trade_id, sequence, product_id, price, size, side, time, ingest_time, msg_offset,
       '{{"type":"match","trade_id":' || coalesce(CAST(trade_id AS VARCHAR), 'null') || ',"sequence":'
         || CAST(sequence AS VARCHAR) || ',"product_id":' || coalesce('"' || product_id || '"', 'null')
         || ',"price":"' || CAST(CAST(price AS BIGINT) AS VARCHAR) || '","size":"' || CAST(CAST(size AS BIGINT) AS VARCHAR)
         || '","side":"buy","time":"' || coalesce(strftime(time, '%Y-%m-%dT%H:%M:%S.%fZ'), 'nope') || '"}}' AS raw_payload
FROM rt""",
    "rough_trades_clean": f"WITH {_rt()} SELECT * FROM clean",
    "rough_bars": f"WITH {_rt()}, trades AS (SELECT * FROM clean), {_bars('minute')} SELECT {BAR_COLS} FROM bars",
    "rough_levels_flatten": f"WITH {RL} SELECT product_id, side, price, size, event_time, sequence FROM levels",
    "rough_levels_latest": f"WITH {RL}, {_latest('latest')} SELECT * FROM latest",
    "rough_levels_incremental": f"""WITH {RL}, {_latest('first_run', "ingest_time < TIMESTAMP '2024-01-16'")},
{_latest('second_run', "ingest_time > (SELECT max(event_time) FROM first_run)")} SELECT * FROM second_run""",
    "rough_levels_ingest_bound": f"""WITH {RL}
SELECT product_id, side, price, size, event_time, sequence, ingest_time FROM (
  SELECT *, row_number() OVER (
    PARTITION BY product_id, side, price
    ORDER BY event_time DESC NULLS LAST, sequence DESC NULLS LAST, size DESC NULLS LAST) AS rn
  FROM levels WHERE ingest_time > (SELECT max(ingest_time) FROM levels WHERE ingest_time < TIMESTAMP '2024-01-16'))
WHERE rn = 1""",
    "rough_levels_reset": _reset("ingest_time"),
    "rough_levels_reset_envelope": _reset("coalesce(sent, ingest_time)"),
    "rough_top_of_book": f"""WITH {RL}, {_latest('latest')},
per_product AS (
  SELECT product_id, max(CASE WHEN side = 'buy' THEN price END) AS best_bid,
         min(CASE WHEN side = 'sell' THEN price END) AS best_ask
  FROM latest WHERE size > 0 GROUP BY product_id)
SELECT product_id, best_bid, best_ask, best_ask - best_bid AS spread FROM per_product""",
    "pipeline_silver_trades": f"WITH {_rt(True)} SELECT trade_id, sequence, product_id, price, size, time FROM clean",
    "pipeline_silver_levels": f"""WITH {RL}, {_latest('first_run', "ingest_time < TIMESTAMP '2024-01-16'")},
{_latest('second_run', "ingest_time > (SELECT max(event_time) FROM first_run)")}
{_anti_union('first_run', 'second_run', LEVEL_KEYS)}""",
    "pipeline_gold": f"WITH {_rt(True)}, trades AS (SELECT * FROM clean), {_bars('minute')} SELECT {BAR_COLS} FROM bars",
    "recent_trades_product": f"""WITH {TRADES},
c AS (SELECT max(time) - INTERVAL '7200' MINUTE AS since FROM trades)
SELECT product_id, time, side, price, size, trade_id FROM trades, c
WHERE time >= since AND product_id = 'purchase' ORDER BY time DESC, trade_id DESC LIMIT 30""",
    "ticker_24h_product": f"""WITH {TRADES}, {_bars('minute')},
a AS (SELECT max(bucket) AS asof_ts FROM bars),
t AS (
  SELECT product_id, arg_max(close, bucket) AS last_price, arg_min(close, bucket) AS first_close,
         max(high) AS high_24h, min(low) AS low_24h, sum(volume) AS volume_24h
  FROM bars, a WHERE bucket >= asof_ts - INTERVAL '24' HOUR AND product_id = 'purchase' GROUP BY product_id)
SELECT *, CASE WHEN first_close = 0 THEN 0.0
               ELSE (last_price - first_close) / first_close * 100.0 END AS change_pct FROM t""",
    "ladder_product": f"WITH {BOOK}, {LEVELS}, {_latest('latest')}, {LADDER} SELECT * FROM ladder WHERE product_id = 'P2'",
    "stream_bronze_resumed": f"WITH {TRADES} SELECT trade_id, product_id, price FROM trades",
}
