"""ANSI SQL that recomputes each registered query from the same tables."""

from __future__ import annotations

from barloom.plans.ticks import SYMBOLS

DECIMALS = 4

_SYMBOL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{s}'" for k, s in SYMBOLS.items()) + " END"

# t: trades; v: the valid ones, timed and classified.
_TICKS = f"""
WITH t AS (
  SELECT event_id AS n,
         CAST(event_id AS VARCHAR) AS event_id,
         event_type,
         {_SYMBOL} AS symbol,
         value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         epoch_us(ts) // 1000 AS source_timestamp,
         epoch_us(ts) // 1000 + (event_id % 7) * 250 AS ingestion_timestamp,
         make_timestamp(epoch_us(ts) // 1000 * 1000) AS trade_time
  FROM events),
v AS (
  SELECT *, CASE WHEN contains(symbol, 'BINANCE') THEN 'Crypto' ELSE 'Stock' END AS asset_class
  FROM t WHERE price > 0 AND volume > 0 AND NOT isnan(price) AND NOT isnan(volume))
"""

# m: the trades as often as their frames stand; v2: those of separate records, valid.
_TIMES = """, m AS (SELECT t.* FROM t, range(1 + (n % 10 = 0)::INT + (n % 7 = 1)::INT))"""

_WATCH = """
w AS (SELECT * FROM (VALUES ('AAPL'), ('MSFT'), ('GOOGL'), ('BINANCE:BTCUSDT'),
                            ('BINANCE:ETHUSDT')) AS x(symbol))
"""


def _bars(unit: str, where: str = "TRUE") -> str:
    return f"""
  SELECT symbol, asset_class, date_trunc('{unit}', trade_time)::TIMESTAMP AS window_start,
         round(arg_min(price, (trade_time, price)), 6) AS open,
         round(max(price), 6) AS high,
         round(min(price), 6) AS low,
         round(arg_max(price, (trade_time, price)), 6) AS close,
         round(sum(volume), 6) AS volume,
         floor(round(sum(price * volume) / sum(volume), 6) * 10000 + 0.505) / 10000 AS vwap,
         count(*) AS tick_count
  FROM v WHERE {where} GROUP BY ALL
"""


def _with_bars(unit: str, tail: str, watch: bool = False, where: str = "TRUE") -> str:
    ctes = f"{_TICKS}, b AS ({_bars(unit, where)})" + (f", {_WATCH}" if watch else "")
    return ctes + tail


_DATE = "strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month, strftime(trade_time, '%d') AS day"
_VENDOR = (
    "CASE WHEN symbol LIKE 'BINANCE:%USDT' "
    "THEN substr(symbol, 9, length(symbol) - 12) || '-USD' ELSE symbol END"
)

_HEALED = """
, s AS (SELECT * FROM b WHERE window_start <= TIMESTAMP '2024-01-25 09:30:00'),
h AS (SELECT symbol, max(window_start) AS last_window FROM s GROUP BY symbol),
f AS (SELECT b.* FROM b JOIN w USING (symbol) LEFT JOIN h USING (symbol)
      WHERE window_start >= TIMESTAMP '2024-01-22 00:00:00'
        AND (last_window IS NULL OR window_start > last_window)
        AND minute(window_start) % 11 <> 0)
SELECT symbol, window_start,
       coalesce(s.asset_class, f.asset_class) AS asset_class,
       coalesce(f.open, s.open) AS open, coalesce(f.high, s.high) AS high,
       coalesce(f.low, s.low) AS low, coalesce(f.close, s.close) AS close,
       coalesce(f.volume, s.volume) AS volume,
       s.vwap AS vwap,
       CASE WHEN s.symbol IS NULL THEN 1 ELSE s.tick_count END AS tick_count
FROM s FULL JOIN f USING (symbol, window_start)
"""

_CANDLES_1M = _with_bars("minute", " SELECT * FROM b")

ORACLE: dict[str, str] = {
    "candles_1m": _CANDLES_1M,
    "candles_1h": _with_bars("hour", " SELECT * FROM b"),
    "candles_1d": _with_bars("day", " SELECT * FROM b"),
    "distinct_symbols_per_window": _with_bars(
        "hour",
        """ SELECT window_start, count(DISTINCT symbol) AS n_symbols, count(*) AS n_candles
            FROM b GROUP BY window_start""",
    ),
    "candles_high_price": f"""{_TICKS},
        p AS (SELECT symbol, asset_class, volume, source_timestamp // 600000 * 600000 AS ms,
                     price * CASE n % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 1000000000 END AS price
              FROM v)
        SELECT symbol, asset_class, date_trunc('hour', make_timestamp(ms * 1000))::TIMESTAMP AS window_start,
               round(arg_min(price, (ms, price)), 2) AS open, round(max(price), 2) AS high,
               round(min(price), 2) AS low, round(arg_max(price, (ms, price)), 2) AS close,
               sum(volume) AS volume, count(*) AS tick_count
        FROM p GROUP BY ALL""",
    "frame_parse": f"""{_TICKS}{_TIMES}
        SELECT symbol, price, volume, source_timestamp,
               CASE WHEN n % 7 = 0 OR n % 5 = 0 THEN '' ELSE event_type END AS conditions
        FROM m""",
    "malformed_quarantine": f"""{_TICKS}{_TIMES}
        SELECT 'bad_price' AS reject_reason, symbol AS subject FROM m WHERE n % 3 = 0
        UNION ALL SELECT 'bad_symbol', '{{"p":"1","v":"1","t":"1"}}' FROM m WHERE n % 13 = 0
        UNION ALL SELECT 'bad_volume', symbol FROM m WHERE n % 17 = 0
        UNION ALL SELECT 'bad_time', symbol FROM m WHERE n % 19 = 0
        UNION ALL SELECT 'bad_element', NULL FROM m WHERE n % 23 = 0
        UNION ALL SELECT 'bad_json', 'not json ' || event_id FROM t WHERE n % 11 = 0""",
    "topic_encode": f"""{_TICKS}
        SELECT symbol AS topic_key, event_id, symbol, price, volume, source_timestamp FROM t""",
    "topic_decode": f"""{_TICKS},
        o AS (SELECT *, CASE WHEN n % 17 = 0 THEN 'bad_utf8' WHEN n % 13 = 0 THEN 'bad_json'
                             ELSE 'ok' END AS outcome FROM t)
        SELECT outcome,
               CASE WHEN outcome = 'ok' THEN event_id END AS event_id,
               CASE WHEN outcome = 'ok' THEN price END AS price,
               CASE WHEN outcome = 'ok' THEN ingestion_timestamp END AS ingestion_timestamp
        FROM o""",
    "bronze_partitions": f"{_TICKS} SELECT {_DATE}, count(*) AS records FROM t GROUP BY ALL",
    "bronze_scan": f"{_TICKS} SELECT event_id, symbol, price, source_timestamp, {_DATE} FROM t",
    "compacted_bronze": f"{_TICKS} SELECT event_id, symbol, price, source_timestamp, {_DATE} FROM t",
    "corrupt_files": f"""{_TICKS},
        s AS (SELECT DISTINCT day(trade_time) % 3 AS kind, CAST(trade_time AS DATE) AS d FROM t)
        SELECT 'read' AS outcome, count(*) AS n, 0::BIGINT AS bytes FROM t
        UNION ALL SELECT CASE kind WHEN 0 THEN 'no_parquet' WHEN 1 THEN 'bad_content' ELSE 'cut_short' END,
                         count(*), (count(*) * CASE kind WHEN 0 THEN 4 WHEN 1 THEN 13 ELSE 8 END)::BIGINT
        FROM s GROUP BY kind""",
    "watchlist_semi": f"""{_TICKS}, {_WATCH}
        SELECT event_id, symbol, price, volume FROM t
        WHERE EXISTS (SELECT 1 FROM w WHERE w.symbol = t.symbol)""",
    "silver_clean": f"""{_TICKS}
        SELECT event_id, symbol, price, volume, source_timestamp, ingestion_timestamp, {_DATE},
               asset_class, trade_time FROM v""",
    "silver_dedup": f"""{_TICKS},
        u AS (SELECT event_id, symbol, price, volume, source_timestamp, ingestion_timestamp FROM v
              UNION ALL
              SELECT event_id, symbol, price, volume, source_timestamp, ingestion_timestamp + 60000
              FROM v WHERE n % 10 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp) AS k
              FROM u)
        SELECT * EXCLUDE (k) FROM r WHERE k = 1""",
    "silver_scan": f"""{_TICKS}
        SELECT event_id, symbol, price, volume, asset_class, {_DATE} FROM v""",
    "quality_counts": f"""{_TICKS},
        u AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE n % 10 = 0),
        c AS (SELECT count(*) AS n_read,
                     count(*) FILTER (WHERE price > 0 AND volume > 0) AS n_valid,
                     count(DISTINCT event_id) FILTER (WHERE price > 0 AND volume > 0) AS n_kept
              FROM u)
        SELECT *, n_read - n_kept AS n_dropped FROM c""",
    "future_ticks": f"""{_TICKS}
        SELECT event_id,
               CASE WHEN source_timestamp + CASE WHEN n % 9 = 0 THEN 86400000 ELSE 0 END
                         > ingestion_timestamp + 5000 THEN 'ahead' ELSE 'kept' END AS outcome
        FROM t""",
    "silver_late": f"""{_TICKS}
        SELECT event_id, symbol, price, volume, source_timestamp, asset_class, {_DATE} FROM v""",
    "asof_load": _with_bars("hour", " SELECT * FROM b", where="day(trade_time) <= 20"),
    "high_watermarks": _with_bars(
        "minute",
        """ SELECT w.symbol, max(b.window_start) AS last_window
            FROM w LEFT JOIN b ON b.symbol = w.symbol GROUP BY w.symbol""",
        watch=True,
    ),
    "symbol_map": f"""{_TICKS}
        SELECT DISTINCT symbol, {_VENDOR} AS vendor_symbol,
               CASE WHEN contains(symbol, 'BINANCE') THEN 'Crypto' ELSE 'Stock' END AS asset_class,
               replace(symbol, ':', '_') AS series
        FROM t""",
    "merge_candles": _with_bars(
        "hour",
        """, s AS (SELECT * REPLACE ('Stored' AS asset_class) FROM b
                   WHERE window_start <= TIMESTAMP '2024-01-16 00:00:00'),
             f AS (SELECT * REPLACE (volume * 2 AS volume, tick_count * 2 AS tick_count) FROM b
                   WHERE window_start >= TIMESTAMP '2024-01-12 00:00:00')
           SELECT symbol, window_start, coalesce(s.asset_class, f.asset_class) AS asset_class,
                  coalesce(f.open, s.open) AS open, coalesce(f.high, s.high) AS high,
                  coalesce(f.low, s.low) AS low, coalesce(f.close, s.close) AS close,
                  coalesce(f.volume, s.volume) AS volume, coalesce(f.vwap, s.vwap) AS vwap,
                  coalesce(f.tick_count, s.tick_count) AS tick_count
           FROM s FULL JOIN f USING (symbol, window_start)""",
    ),
    "merge_daily": _with_bars(
        "day",
        """, s AS (SELECT symbol, window_start, 0.0::DOUBLE AS open, 0.0::DOUBLE AS high,
                          0.0::DOUBLE AS low, 0.0::DOUBLE AS close, 0.0::DOUBLE AS volume
                   FROM b WHERE window_start <= TIMESTAMP '2024-01-20 00:00:00'),
             h AS (SELECT symbol, max(window_start) AS last_window FROM s GROUP BY symbol),
             f AS (SELECT b.* FROM b JOIN w USING (symbol) LEFT JOIN h USING (symbol)
                   WHERE window_start >= coalesce(last_window, TIMESTAMP '2021-01-31 00:00:00')
                     AND dayofyear(window_start) % 11 <> 0)
           SELECT symbol, window_start,
                  coalesce(f.open, s.open) AS open, coalesce(f.high, s.high) AS high,
                  coalesce(f.low, s.low) AS low, coalesce(f.close, s.close) AS close,
                  coalesce(f.volume, s.volume) AS volume
           FROM s FULL JOIN f USING (symbol, window_start)""",
        watch=True,
    ),
    "merge_heal": _with_bars("minute", _HEALED, watch=True),
    "merge_precedence": _with_bars(
        "minute",
        """ SELECT symbol, asset_class, window_start,
                   open + healed AS open, high + healed AS high, low + healed AS low,
                   close + healed AS close, volume + healed AS volume,
                   CASE WHEN healed = 0 THEN vwap END AS vwap,
                   CASE WHEN healed = 0 THEN tick_count ELSE 1 END AS tick_count
            FROM (SELECT *, CASE WHEN minute(window_start) % 2 = 0 THEN 0 ELSE 200 END AS healed FROM b)""",
    ),
    "heal_gaps": _with_bars(
        "minute",
        """ SELECT symbol, asset_class, window_start, open, high, low, close, volume
            FROM b JOIN w USING (symbol)
            WHERE window_start >= TIMESTAMP '2024-01-22 00:00:00'
              AND minute(window_start) % 7 = 0 AND minute(window_start) % 11 <> 0""",
        watch=True,
    ),
    "raw_backup": _with_bars(
        "day",
        f""" SELECT {_VENDOR} AS symbol,
                    strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
                    open, high, low, close, volume,
                    '2024' AS year, '01' AS month, '31' AS day,
                    replace({_VENDOR}, ':', '_') AS series
             FROM b WHERE dayofyear(window_start) % 11 <> 0""",
    ),
    "daily_load": _with_bars(
        "day",
        """, k AS (SELECT b.* FROM b JOIN w USING (symbol)
                   WHERE dayofyear(window_start) % 11 <> 0),
             h AS (SELECT symbol, max(window_start) AS last_window FROM k
                   WHERE window_start <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY symbol)
           SELECT symbol, window_start, open, high, low, close, volume,
                  last_window IS NULL OR window_start >= last_window AS backed_up
           FROM k LEFT JOIN h USING (symbol)""",
        watch=True,
    ),
    "heal_job": _with_bars("minute", _HEALED, watch=True),
    "mart_adhoc": _with_bars(
        "minute",
        """ SELECT symbol, CAST(window_start AS DATE) AS trade_day, max(high) AS day_high,
                   min(low) AS day_low, CAST(sum(tick_count) AS BIGINT) AS ticks
            FROM b
            WHERE asset_class = 'Crypto' AND window_start >= TIMESTAMP '2024-01-10 00:00:00'
            GROUP BY ALL""",
    ),
    "latency_stats": f"""{_TICKS},
        d AS (SELECT symbol, n * 7919 % 10007 AS ms FROM t),
        r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ms) AS k,
                     count(*) OVER (PARTITION BY symbol) AS c FROM d)
        SELECT symbol, count(*) AS n_ticks, round(avg(ms), {DECIMALS}) AS avg_ms,
               min(ms) AS min_ms, max(ms) AS max_ms,
               min(ms) FILTER (WHERE k * 100 >= c * 50) AS p50_ms,
               min(ms) FILTER (WHERE k * 100 >= c * 95) AS p95_ms,
               min(ms) FILTER (WHERE k * 100 >= c * 99) AS p99_ms
        FROM r GROUP BY symbol""",
    "flow_rates": f"""{_TICKS}
        SELECT date_trunc('hour', trade_time)::TIMESTAMP AS window_start,
               CASE WHEN contains(symbol, 'BINANCE') THEN 'Crypto' ELSE 'Stock' END AS asset_class,
               symbol, count(*) AS n_ticks, sum(volume) AS volume
        FROM t GROUP BY ALL""",
    "pulse_no_data": f"""{_TICKS}, {_WATCH},
        l AS (SELECT symbol, max(trade_time) AS last_tick, count(*) AS n_ticks
              FROM t GROUP BY symbol),
        i AS (SELECT w.symbol, last_tick, coalesce(n_ticks, 0) AS n_ticks,
                     (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_tick)) // 1000000
                         AS idle_seconds
              FROM w LEFT JOIN l ON l.symbol = w.symbol)
        SELECT *, last_tick IS NULL OR idle_seconds > 14400 AS no_data FROM i""",
    "live_pulse": f"""{_TICKS}, {_WATCH},
        p AS (SELECT symbol, source_timestamp AS ms,
                     lead(source_timestamp) OVER (PARTITION BY symbol ORDER BY source_timestamp) AS following
              FROM t WHERE symbol IN (SELECT symbol FROM w)),
        e AS (SELECT max(ms) - 300000 AS ended FROM p)
        SELECT symbol, 'silent' AS status, make_timestamp(ms * 1000) AS since, make_timestamp((ms + 1800000) * 1000) AS at
        FROM p, e WHERE (following IS NULL OR following - ms > 1800000) AND ms + 1800000 <= ended
        UNION ALL
        SELECT symbol, 'back', make_timestamp(ms * 1000), make_timestamp(following * 1000)
        FROM p, e WHERE following - ms > 1800000 AND following <= ended""",
    "live_flow": f"""{_TICKS},
        e AS (SELECT max(trade_time) - INTERVAL 5 MINUTE AS ended FROM t)
        SELECT date_trunc('hour', trade_time)::TIMESTAMP AS window_start,
               CASE WHEN contains(symbol, 'BINANCE') THEN 'Crypto' ELSE 'Stock' END AS asset_class,
               symbol, count(*) AS n_ticks, sum(volume) AS volume
        FROM t, e WHERE date_trunc('hour', trade_time) + INTERVAL 1 HOUR <= ended GROUP BY ALL""",
    "gap_minutes": _with_bars(
        "minute",
        """, r AS (SELECT symbol, unnest(generate_series(min(window_start), max(window_start),
                                                         INTERVAL 1 MINUTE)) AS window_start
                   FROM b GROUP BY symbol)
           SELECT symbol, window_start FROM r
           WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.symbol = r.symbol
                                               AND b.window_start = r.window_start)""",
    ),
    "replay_day_range": _with_bars(
        "minute",
        " SELECT * FROM b",
        where="CAST(trade_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'",
    ),
    "stream_candles": _with_bars("hour", " SELECT * FROM b"),
    "late_repair": _with_bars("hour", " SELECT * FROM b"),
    "live_candles": f"""{_TICKS.replace("v AS (", "v1 AS (")},
        v AS (SELECT v1.* FROM v1, range(1 + (n % 10 = 0)::INT + (n % 7 = 1)::INT)),
        b AS ({_bars("minute")}) SELECT * FROM b""",
    "live_counters": f"""{_TICKS}{_TIMES},
        c AS (SELECT count(*) AS n_read, count(*) FILTER (WHERE price > 0 AND volume > 0) AS n_kept,
                     sum((n % 3 = 0)::INT + (n % 13 = 0)::INT + (n % 17 = 0)::INT + (n % 19 = 0)::INT + (n % 23 = 0)::INT) AS n_bad
              FROM m)
        SELECT 'bronze' AS counter, n_read AS n FROM c UNION ALL SELECT 'silver_read', n_read FROM c
        UNION ALL SELECT 'silver_kept', n_kept FROM c
        UNION ALL SELECT 'quarantine', CAST(n_bad + (SELECT count(*) FROM t WHERE n % 11 = 0) AS BIGINT) FROM c""",
    "medallion": f"""{_TICKS.replace("v AS (", "v1 AS (")},
        v AS (SELECT * FROM v1 UNION ALL SELECT * FROM v1 WHERE n % 10 = 0),
        b AS ({_bars("minute")}) SELECT * FROM b""",
    "medallion_rejects": f"""{_TICKS}{_TIMES}
        SELECT reject_reason, count(*) AS n FROM (
            SELECT unnest(list_filter([
                CASE WHEN n % 3 = 0 THEN 'bad_price' END, CASE WHEN n % 13 = 0 THEN 'bad_symbol' END,
                CASE WHEN n % 17 = 0 THEN 'bad_volume' END, CASE WHEN n % 19 = 0 THEN 'bad_time' END,
                CASE WHEN n % 23 = 0 THEN 'bad_element' END], lambda x: x IS NOT NULL)) AS reject_reason FROM m
            UNION ALL SELECT 'bad_json' FROM t WHERE n % 11 = 0)
        GROUP BY reject_reason""",
}
