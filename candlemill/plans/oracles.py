"""The registered queries in plain SQL, for checking results on another engine."""

from candlemill.operators.features import REG12_INPUTS
from candlemill.operators.signals import DIFF, DOWN, MATCH, UP
from candlemill.plans import inputs as I
from candlemill.plans.queries import BACKTEST_LIMIT, CHART_BARS
from candlemill.schemas import EMPTY_START_MS, LIVE_BARS

VALUE_COLS = "open, high, low, close, volume, number_of_trades"
COLS = f'symbol, "timestamp", {VALUE_COLS}'


def bars(name, where="", extra=""):
    return f"""{name} AS (
        SELECT upper(event_type) AS symbol, date_trunc('hour', ts) AS "timestamp",
               arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, event_id) AS close,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume,
               count(*) AS number_of_trades{extra}
        FROM events {where} GROUP BY 1, 2)"""


CANDLES = bars("candles")
STORED = bars("stored", f"WHERE ts < TIMESTAMP '{I.STORED_BEFORE}'")
RECENT = bars("recent", f"WHERE ts >= TIMESTAMP '{I.LIVE_FROM}'")
LIVE = f"""{RECENT}, live AS (
        SELECT symbol, "timestamp", open, high, low, close + 1 AS close, volume,
               number_of_trades, true AS is_closed FROM recent)"""
SUPPLIER = """candles AS (
        SELECT 'S' || l_suppkey AS symbol,
               CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS "timestamp",
               arg_min(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS open,
               max(l_extendedprice) AS high, min(l_extendedprice) AS low,
               arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS close,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
               count(*) AS number_of_trades
        FROM lineitem GROUP BY 1, 2)"""
SYMBOLS = "symbols(symbol) AS (VALUES {})".format(
    ", ".join(f"('{s}')" for s in [*I.EVENT_SYMBOLS, I.EMPTY_SYMBOL])
)
W = 'PARTITION BY symbol ORDER BY "timestamp"'

TRAIN_LAGS = f"""lag(close, 1) OVER w AS lag_close_1, lag(close, 3) OVER w AS lag_close_3,
    lag(close, 5) OVER w AS lag_close_5, lag(volume, 1) OVER w AS lag_volume_1"""
SPREAD = "high - low AS hl_spread"
SPREAD_8 = "round(high - low, 8) AS hl_spread"


def frame(n):
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


TRAIN_ROLL = f"""round(avg(close) OVER {frame(16)}, 8) AS rolling_avg_15m,
    round(avg(close) OVER {frame(61)}, 8) AS rolling_avg_1h,
    round(stddev_samp(close) OVER {frame(16)}, 8) AS volatility_15m"""
# Unrounded, for formulas that use them.
SERVE_ROLL = f"""avg(close) OVER {frame(5)} AS rolling_avg_close_5,
    avg(close) OVER {frame(15)} AS rolling_avg_15m,
    avg(close) OVER {frame(60)} AS rolling_avg_1h,
    coalesce(stddev_samp(close) OVER {frame(15)}, 0.0) AS volatility_15m"""
SERVE_ROLL_8 = """round(rolling_avg_close_5, 8) AS rolling_avg_close_5,
    round(rolling_avg_15m, 8) AS rolling_avg_15m, round(rolling_avg_1h, 8) AS rolling_avg_1h,
    round(volatility_15m, 8) AS volatility_15m"""
PCT = "CASE WHEN open <> 0 THEN (close - open) / open END"
PCT_GUARDED = "CASE WHEN open = 0 THEN 0.0 ELSE (close - open) / open END"
PCT_8 = f"round({PCT}, 8) AS price_change_pct"
SERVE_LAGS = {
    "lag_close_1": "lag(close, 1)",
    "lag_close_2": "lag(close, 2)",
    "lag_close_3": "lag(close, 3)",
    "lag_close_5": "lag(close, 5)",
    "lag_volume_1": "lag(volume, 1)",
}


def fill(c):
    return f"""coalesce(
        first_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        0.0) AS {c}"""


def newest(source, n, columns="*"):
    return f"""SELECT {columns} FROM {source}
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= {n}"""


def serve(source, out):
    """CTEs that end in ``out``: serving features, unrounded."""
    raw = ", ".join(f"{expr} OVER w AS {name}" for name, expr in SERVE_LAGS.items())
    filled = ", ".join(fill(name) for name in SERVE_LAGS)
    return f"""{out}_raw AS (
        SELECT *, {raw}, {SPREAD}, {PCT_GUARDED} AS price_change_pct, {SERVE_ROLL}
        FROM {source} WINDOW w AS ({W})),
    {out} AS (SELECT * REPLACE ({filled}) FROM {out}_raw)"""


def so_far(source, out):
    """As ``serve``, but a missing lag takes the value before it within 60 rows."""
    lags = [
        f"""coalesce(last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN 59 PRECEDING AND {k} PRECEDING), 0.0)
            AS lag_{c}_{k}"""
        for c, k in [("close", 1), ("close", 2), ("close", 3), ("close", 5), ("volume", 1)]
    ]
    return f"""{out} AS (
        SELECT *, {", ".join(lags)}, {SPREAD}, {PCT_GUARDED} AS price_change_pct, {SERVE_ROLL} FROM {source})"""


SERVE_SELECT = f"""SELECT {COLS}, lag_close_1, lag_close_2, lag_close_3, lag_close_5, lag_volume_1,
    round(hl_spread, 8) AS hl_spread, round(price_change_pct, 8) AS price_change_pct, {SERVE_ROLL_8}
    FROM feat"""


def wide(sql):
    """Prices near 10^5: fewer decimals than for small prices."""
    for name in ["rolling_avg_close_5", "rolling_avg_15m", "rolling_avg_1h"]:
        sql = sql.replace(f", 8) AS {name}", f", 7) AS {name}")
    return sql.replace(", 8) AS volatility_15m", ", 5) AS volatility_15m")


def train_features(source_cte):
    return f"""WITH {source_cte}
    SELECT *, {TRAIN_LAGS}, {SPREAD_8}, {PCT_8}, {TRAIN_ROLL}
    FROM candles WINDOW w AS ({W})"""


TRAINING_SET = f"""feat AS (
        SELECT *, {TRAIN_LAGS}, {SPREAD_8}, {PCT_8}, {TRAIN_ROLL},
               lead(close) OVER w AS next_close
        FROM candles WINDOW w AS ({W})),
    training AS (
        SELECT *, CASE WHEN next_close > close THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
        FROM feat
        WHERE lag_close_5 IS NOT NULL AND volatility_15m IS NOT NULL AND next_close IS NOT NULL
          AND price_change_pct IS NOT NULL)"""

SCORE = "{} * price_change_pct + {} * ((close - rolling_avg_15m) / (rolling_avg_15m + 1e-6))"


def backtest(source_cte):
    return f"""WITH {source_cte},
    cut AS ({newest("candles", BACKTEST_LIMIT + 10)}),
    {serve("cut", "feat")},
    rows_ AS (
        SELECT *, lead(close) OVER w AS next_close, count(*) OVER (PARTITION BY symbol) AS n,
               {SCORE.format(0.6, 0.4)} AS score
        FROM feat WINDOW w AS ({W})),
    judged AS (
        SELECT *, next_close > close AS up, score >= 0 AS guess
        FROM rows_ WHERE n >= 3 AND next_close IS NOT NULL),
    shown AS ({newest("judged", BACKTEST_LIMIT)})"""


BACKTEST_SELECT = f"""SELECT "timestamp" AS "Time", symbol AS "Symbol", close AS "Current Price",
    next_close AS "Next Minute Price",
    CASE WHEN up THEN '{UP}' ELSE '{DOWN}' END AS "Actual Trend",
    CASE WHEN guess THEN '{UP}' ELSE '{DOWN}' END AS "AI Prediction Signal",
    CASE WHEN up = guess THEN '{MATCH}' ELSE '{DIFF}' END AS "Accuracy Match"
    FROM shown"""

HOUR = I.HOUR_MS
LATEST = f"""{CANDLES}, {SYMBOLS},
    latest AS (
        SELECT s.symbol, max(epoch_ms(c."timestamp")) AS latest_ms
        FROM symbols s LEFT JOIN candles c ON c.symbol = s.symbol GROUP BY 1),
    plan AS (
        SELECT symbol, latest_ms, latest_ms + 1 AS start_ms,
               coalesce({I.GAP_NOW_MS} - (latest_ms + 1) >= {HOUR}, false) AS needed FROM latest)"""

# The pages cover the candles from LIVE_FROM on, plus one unfinished bar to be dropped.
FETCHED = f"""{STORED}, {RECENT}, fetched AS (
        SELECT {COLS} FROM recent r
        WHERE NOT EXISTS (SELECT 1 FROM stored s
                          WHERE s.symbol = r.symbol AND s."timestamp" = r."timestamp"))"""

MERGED = f"""{STORED}, {LIVE}, merged AS (
        SELECT {COLS}, CAST(NULL AS BOOLEAN) AS is_closed FROM stored s
        WHERE NOT EXISTS (SELECT 1 FROM live l
                          WHERE l.symbol = s.symbol AND l."timestamp" = s."timestamp")
        UNION ALL SELECT {COLS}, is_closed FROM live)"""

TICK_VALUES = "value AS open, value AS high, value AS low, value AS close, value AS volume"
KLINES = f"""{bars("candles", extra=", max(event_id) AS last_id")},
    ticks AS (
        SELECT event_id, upper(event_type) AS symbol, date_trunc('hour', ts) AS "timestamp",
               value, {TICK_VALUES}, 1::BIGINT AS number_of_trades FROM events),
    klines AS (
        SELECT event_id * 4 AS "offset", {COLS}, false AS is_closed
        FROM ticks WHERE value >= {I.DAMAGED_BELOW}
        UNION ALL SELECT event_id * 4 + {I.RESENT_OFFSET}, {COLS}, false
        FROM ticks WHERE value >= {I.RESENT_FROM}
        UNION ALL SELECT last_id * 4 + 2, {COLS}, true FROM candles)"""
STATE = f"""{KLINES}, state AS (
        SELECT * FROM klines
        QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY "offset" DESC) = 1)"""
UNKEYED = f"""{KLINES}, arrived AS (
        SELECT CAST("offset" % {I.PARTITIONS} AS INTEGER) AS "partition",
               CAST(("offset" - CASE WHEN "offset" >= {I.RESENT_OFFSET} THEN {I.RESENT_OFFSET} ELSE 0 END)
                    // {I.PARTITIONS} AS BIGINT) AS "offset",
               TIMESTAMP '{I.TOPIC_START}' + to_microseconds(CAST("offset" // 1000 AS BIGINT)) AS time,
               {COLS}, is_closed FROM klines)"""
UNKEYED_STATE = f"""{UNKEYED}, state AS (
        SELECT * FROM arrived
        QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp"
                                   ORDER BY time DESC, "partition" DESC, "offset" DESC) = 1)"""
KLINE_TEXT = "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S')"
TICKERS = """tickers AS (
        SELECT event_id * 4 + 1 AS "offset", 'ticker' AS type, upper(event_type) AS symbol,
               value AS price, 0.0::DOUBLE AS change_pct, value AS volume FROM events)"""


def money(c):
    return f"format('${{:,.4f}}', {c})"


ORACLES = {
    "csv_candle_scan": f"WITH {CANDLES} SELECT * FROM candles",
    "symbol_from_path": f"""WITH {CANDLES}
        SELECT symbol, count(*) AS n_rows FROM candles GROUP BY 1
        UNION ALL SELECT '', count(*) FROM candles WHERE symbol = 'ERROR'""",
    "csv_rejects": f"""WITH {CANDLES}
        SELECT symbol, 'bad time' AS reason, count(*) AS n_rows FROM candles
        WHERE date_part('hour', "timestamp") = 0 GROUP BY 1""",
    "canonical_candles": f"WITH {CANDLES} SELECT * FROM candles",
    "rest_page_decode": f"""WITH {CANDLES}, rows_ AS (
            SELECT * FROM candles UNION ALL
            SELECT DISTINCT symbol, make_timestamp({I.UNFINISHED_MS} * 1000), 1.0, 1.0, 1.0, 1.0, 1.0, 1
            FROM candles)
        SELECT *, epoch_ms("timestamp") AS open_ms, epoch_ms("timestamp") + {HOUR - 1} AS close_ms
        FROM rows_""",
    "rest_rejects": f"""WITH {CANDLES}, rows_ AS (
            SELECT symbol, epoch_ms("timestamp") AS ms FROM candles
            UNION ALL SELECT DISTINCT symbol, {I.UNFINISHED_MS} FROM candles)
        SELECT 'VIEW' AS symbol, 'no page' AS reason, count(DISTINCT ms // {I.PAGE_BARS * I.HOUR_MS}) AS n_rows
        FROM rows_ WHERE symbol = 'VIEW'
        UNION ALL SELECT 'CLICK', 'bad time', count(*) FROM rows_ WHERE symbol = 'CLICK'""",
    "latest_n_candles": f"WITH {CANDLES} {newest('candles', 100)}",
    "latest_n_candles_wide": f"WITH {SUPPLIER} {newest('candles', 12)}",
    "latest_timestamp": f"""WITH {CANDLES}
        SELECT symbol, max("timestamp") AS max_timestamp FROM candles GROUP BY 1""",
    "load_report": f"""WITH {CANDLES}
        SELECT symbol, count(*) AS n_rows, min("timestamp") AS first_timestamp,
               max("timestamp") AS last_timestamp FROM candles GROUP BY 1""",
    "candle_lags": f"WITH {CANDLES} SELECT *, {TRAIN_LAGS} FROM candles WINDOW w AS ({W})",
    "candle_rolling_train": f"WITH {CANDLES} SELECT *, {TRAIN_ROLL} FROM candles",
    "candle_rolling_serve": f"""WITH {CANDLES}, feat AS (SELECT *, {SERVE_ROLL} FROM candles)
        SELECT {COLS}, {SERVE_ROLL_8} FROM feat""",
    "candle_returns": f"""WITH {CANDLES}, rows_ AS (
            SELECT * REPLACE (CASE WHEN number_of_trades = 1 THEN 0.0 ELSE open END AS open) FROM candles)
        SELECT *, {SPREAD_8}, {PCT_8}, round({PCT_GUARDED}, 8) AS price_change_pct_guarded
        FROM rows_""",
    "candle_features_train": train_features(CANDLES),
    "layout_features_train": train_features(CANDLES),
    "layout_newest": f"WITH {CANDLES} {newest('candles', CHART_BARS)}",
    "candle_features_train_wide": wide(train_features(SUPPLIER)),
    "candle_features_serve": f"WITH {CANDLES}, {serve('candles', 'feat')} {SERVE_SELECT}",
    "candle_features_so_far": f"""WITH {CANDLES}, quiet AS (
            SELECT * REPLACE (CASE WHEN number_of_trades > 1 THEN close END AS close) FROM candles),
        {so_far('quiet', 'feat')} {SERVE_SELECT}""",
    "candle_features_serve_wide": wide(
        f"WITH {SUPPLIER}, {serve('candles', 'feat')} {SERVE_SELECT}"
    ),
    "candle_features_reg12": f"""WITH {CANDLES}, {serve('candles', 'feat')},
        shown AS ({SERVE_SELECT})
        SELECT symbol, "timestamp", {', '.join(REG12_INPUTS)} FROM shown""",
    "candle_training_set": f"WITH {CANDLES}, {TRAINING_SET} SELECT * FROM training",
    "null_fill_bidirectional": f"""WITH {CANDLES},
        blanked AS (
            SELECT * REPLACE (CASE WHEN number_of_trades > 1 THEN close END AS close,
                              CASE WHEN number_of_trades > 1 THEN volume END AS volume)
            FROM candles)
        SELECT * REPLACE ({fill("close")}, {fill("volume")}) FROM blanked""",
    "time_split": f"""WITH {CANDLES}, {TRAINING_SET},
        timed AS (SELECT symbol, "timestamp", close, label,
                         CAST(epoch("timestamp") AS BIGINT) AS ts_unix FROM training)
        SELECT *, ts_unix <= (SELECT quantile_disc(ts_unix, 0.8) FROM timed) AS is_train
        FROM timed""",
    "time_split_sketched": f"""WITH {CANDLES}, {TRAINING_SET}
        SELECT count(*) AS n_rows, true AS near FROM training""",
    "merge_insert_ignore": f"""WITH {STORED}, {LIVE}
        SELECT {COLS} FROM stored UNION ALL
        SELECT {COLS} FROM live l
        WHERE NOT EXISTS (SELECT 1 FROM stored s
                          WHERE s.symbol = l.symbol AND s."timestamp" = l."timestamp")""",
    "merge_upsert": f"WITH {MERGED} SELECT {COLS} FROM merged",
    "merge_upsert_last_wins": f"""WITH {STORED}, batch AS (
            SELECT upper(event_type) AS symbol, date_trunc('hour', ts) AS "timestamp",
                   {TICK_VALUES}, 1::BIGINT AS number_of_trades
            FROM events WHERE ts >= TIMESTAMP '{I.LIVE_FROM}'
            QUALIFY row_number() OVER (PARTITION BY upper(event_type), date_trunc('hour', ts)
                                       ORDER BY event_id DESC) = 1)
        SELECT {COLS} FROM stored s
        WHERE NOT EXISTS (SELECT 1 FROM batch b
                          WHERE b.symbol = s.symbol AND b."timestamp" = s."timestamp")
        UNION ALL SELECT {COLS} FROM batch""",
    "merge_repeated_keys": f"WITH {MERGED} SELECT {COLS} FROM merged",
    "table_upsert_commit": f"WITH {MERGED} SELECT {COLS} FROM merged",
    "table_insert_commit": f"""WITH {STORED}, {LIVE}
        SELECT {COLS} FROM stored UNION ALL
        SELECT {COLS} FROM live l
        WHERE NOT EXISTS (SELECT 1 FROM stored s
                          WHERE s.symbol = l.symbol AND s."timestamp" = l."timestamp")""",
    "table_newest": f"WITH {CANDLES} {newest('candles', CHART_BARS)}",
    "table_faults": f"""WITH {STORED}, {LIVE},
        blanked AS (
            SELECT * REPLACE (CASE WHEN number_of_trades > 1 THEN close END AS close) FROM stored),
        kept AS (
            SELECT {COLS} FROM blanked s
            WHERE NOT EXISTS (SELECT 1 FROM live l
                              WHERE s.symbol = l.symbol AND s."timestamp" = l."timestamp")
            UNION ALL SELECT {COLS} FROM live)
        SELECT symbol, strftime("timestamp", '%Y-%m') AS month, count(*) AS n_rows,
               count(*) FILTER (close IS NULL OR volume IS NULL) AS n_null_prices,
               count(*) - count(DISTINCT "timestamp") AS n_duplicate_keys
        FROM kept GROUP BY ALL HAVING n_null_prices > 0 OR n_duplicate_keys > 0""",
    "live_history_merge": f"WITH {MERGED} SELECT * FROM merged",
    "live_history_chart": f"WITH {MERGED} {newest('merged', CHART_BARS)}",
    "candle_metrics": f"""WITH {MERGED},
        paired AS (
            SELECT *, lag(close) OVER w AS before_, row_number() OVER w AS at_ FROM merged
            WINDOW w AS ({W})),
        top AS ({newest('paired', 1)}),
        newest_live AS (
            SELECT symbol, number_of_trades > 1 AS closed_ FROM ({newest('live', 1)})
            WHERE symbol <> 'VIEW'),
        changed AS (
            SELECT *, CASE WHEN at_ > 1 THEN before_ ELSE open END AS previous_close FROM top),
        pct AS (
            SELECT *, CASE WHEN previous_close = 0 THEN 0.0
                      ELSE (close - previous_close) / previous_close * 100 END AS p FROM changed)
        SELECT c.symbol, "timestamp", open, high, low, close, previous_close,
               round(close - previous_close, 8) AS difference, round(p, 8) AS percentage,
               {money('close')} AS close_text, printf('%+.3f%%', p) AS change_text,
               {money('open')} AS open_text, {money('high')} AS high_text, {money('low')} AS low_text,
               CASE WHEN l.symbol IS NULL THEN 'Kafka Streaming...'
                    WHEN closed_ THEN 'CLOSED' ELSE 'LIVE STREAM 🟢' END AS status
        FROM pct c LEFT JOIN newest_live l ON l.symbol = c.symbol""",
    "signal_latest": f"""WITH {CANDLES}, {SYMBOLS}, cut AS ({newest('candles', 100)}),
        {serve('cut', 'feat')},
        top AS ({newest('feat', 1)}),
        scored AS (SELECT *, {SCORE.format(0.5, 0.3)} AS score FROM top)
        SELECT s.symbol, coalesce("timestamp", TIMESTAMP '{I.NOW}') AS "timestamp",
               coalesce(close, 0.0) AS current_price,
               CASE WHEN coalesce(score, 0) >= 0 THEN '{UP}' ELSE '{DOWN}' END AS prediction_signal,
               CASE WHEN coalesce(score, 0) >= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction_raw,
               round(sure, 8) AS confidence_exact, round(sure, 1) AS confidence,
               round(coalesce(price_change_pct, 0.0), 8) AS price_change_pct,
               round(coalesce(rolling_avg_15m, 0.0), 8) AS rolling_avg_15m,
               round(coalesce(rolling_avg_1h, 0.0), 8) AS rolling_avg_1h,
               round(coalesce(volatility_15m, 0.0), 8) AS volatility_15m,
               round(coalesce(hl_spread, 0.0), 8) AS hl_spread,
               CASE WHEN t.symbol IS NULL THEN 'GBT Classifier'
                    ELSE 'Gradient Boosting Signal Engine' END AS model_name
        FROM symbols s LEFT JOIN scored t ON t.symbol = s.symbol,
            LATERAL (SELECT CASE WHEN t.symbol IS NULL THEN 75.0
                     ELSE least(95.0, greatest(60.0, 70.0 + abs(score) * 500)) END AS sure)""",
    "signal_backtest": f"{backtest(CANDLES)} {BACKTEST_SELECT}",
    "signal_backtest_wide": f"{backtest(SUPPLIER)} {BACKTEST_SELECT}",
    "signal_accuracy": f"""{backtest(CANDLES)}
        SELECT symbol, count(*) AS n_rows,
               round(avg(CASE WHEN up = guess THEN 1.0 ELSE 0.0 END), 8) AS accuracy
        FROM shown GROUP BY 1""",
    "gap_plan": f"WITH {LATEST} SELECT * FROM plan",
    "gap_plan_startup": f"""WITH {LATEST}
        SELECT symbol, latest_ms, coalesce(latest_ms + {HOUR}, {EMPTY_START_MS}) AS start_ms
        FROM latest""",
    "gap_pages": f"""WITH RECURSIVE {LATEST},
        pages(symbol, latest_ms, page, start_ms) AS (
            SELECT symbol, latest_ms, 0::BIGINT, start_ms FROM plan WHERE needed
            UNION ALL
            SELECT symbol, latest_ms, page + 1,
                   latest_ms + ((page + 1) * {I.PAGE_BARS} + 1) * {HOUR}
            FROM pages
            WHERE latest_ms + ((page + 1) * {I.PAGE_BARS} + 1) * {HOUR} < {I.GAP_NOW_MS})
        SELECT symbol, page, start_ms FROM pages""",
    "gap_backfill": f"""WITH {FETCHED}
        SELECT {COLS} FROM stored UNION ALL SELECT {COLS} FROM fetched""",
    "backfill_report": f"""WITH {FETCHED}
        SELECT symbol, count(*) AS rows_added FROM fetched GROUP BY 1""",
    "missing_bars": f"""WITH {CANDLES},
        spans AS (SELECT symbol, min("timestamp") AS lo, max("timestamp") AS hi
                  FROM candles GROUP BY 1),
        grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp"
                 FROM spans)
        SELECT symbol, "timestamp" FROM grid
        EXCEPT SELECT symbol, "timestamp" FROM candles""",
    "hole_pages": f"""WITH RECURSIVE {CANDLES},
        spans AS (SELECT symbol, min("timestamp") AS lo, max("timestamp") AS hi FROM candles GROUP BY 1),
        grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp" FROM spans),
        missing AS (SELECT symbol, epoch_ms("timestamp") AS ms FROM (
            SELECT symbol, "timestamp" FROM grid EXCEPT SELECT symbol, "timestamp" FROM candles)),
        pages(symbol, start_ms) AS (
            SELECT symbol, min(ms) FROM missing GROUP BY 1
            UNION ALL
            SELECT p.symbol, (SELECT min(ms) FROM missing m
                              WHERE m.symbol = p.symbol AND m.ms >= p.start_ms + {I.HOLE_PAGE_BARS * HOUR})
            FROM pages p WHERE p.start_ms IS NOT NULL)
        SELECT p.symbol, start_ms, max(ms) AS last_ms, count(*) AS n_missing
        FROM pages p JOIN missing m ON m.symbol = p.symbol
             AND m.ms >= start_ms AND m.ms < start_ms + {I.HOLE_PAGE_BARS * HOUR}
        GROUP BY 1, 2""",
    "dq_no_null_prices": f"""WITH {CANDLES}
        SELECT symbol, count(*) FILTER (WHERE symbol = 'VIEW' AND number_of_trades = 1) = 0 AS ok
        FROM candles GROUP BY 1""",
    "dq_zero_volume": f"""WITH {CANDLES}
        SELECT symbol, count(*) AS n_rows, count(*) FILTER (WHERE floor(volume) = 0) AS n_zero_volume
        FROM candles GROUP BY 1""",
    "dq_key_unique": f"""WITH {STORED}, {RECENT},
        both_ AS (SELECT symbol, "timestamp" FROM stored
                  UNION ALL SELECT symbol, "timestamp" FROM recent)
        SELECT symbol, "timestamp", count(*) AS n_rows FROM both_ GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_null_keys": f"""WITH {CANDLES}
        SELECT count(*) FILTER (WHERE number_of_trades = 1) AS n_null_symbol,
               count(*) FILTER (WHERE number_of_trades = 2) AS n_null_timestamp FROM candles""",
    "feed_demux_ticker": f"WITH {TICKERS} SELECT * FROM tickers",
    "feed_demux_kline": f"""WITH {KLINES}
        SELECT "offset", 'kline' AS type, symbol, {KLINE_TEXT} AS "timestamp", {VALUE_COLS}, is_closed
        FROM klines""",
    "feed_rejects": f"""SELECT event_id * 4 AS "offset", '{{bad' AS value, 'no envelope' AS reason
        FROM events WHERE value < {I.DAMAGED_BELOW}""",
    "kafka_payload_encode": f"""WITH {KLINES}
        SELECT "offset", symbol AS key, CAST(to_json({{
            'type': 'kline', 'symbol': symbol, 'timestamp': {KLINE_TEXT}, 'open': open,
            'high': high, 'low': low, 'close': close, 'volume': volume,
            'number_of_trades': number_of_trades, 'is_closed': is_closed}}) AS VARCHAR) AS value
        FROM klines""",
    "kline_stream_decode": f"WITH {KLINES} SELECT * FROM klines",
    "topic_rejects": f"""WITH {KLINES}, {TICKERS}, sent AS (
            SELECT "offset", true AS kline FROM klines UNION ALL SELECT "offset", false FROM tickers)
        SELECT "offset", CASE WHEN "offset" % 97 = 0 THEN 'no message'
                              WHEN "offset" % 101 = 0 THEN 'bad time' ELSE 'bad field' END AS reason
        FROM sent
        WHERE "offset" % 97 = 0 OR kline AND ("offset" % 101 = 0 OR "offset" % 103 = 0)""",
    "live_candle_state": f"WITH {STATE} SELECT * FROM state",
    "live_state_chart": f"""WITH {STATE}, {STORED}, merged AS (
            SELECT {COLS}, CAST(NULL AS BOOLEAN) AS is_closed FROM stored s
            WHERE NOT EXISTS (SELECT 1 FROM state l
                              WHERE l.symbol = s.symbol AND l."timestamp" = s."timestamp")
            UNION ALL SELECT {COLS}, is_closed FROM state)
        {newest('merged', CHART_BARS)}""",
    "live_latest_candle": f"""WITH {KLINES} SELECT * FROM klines
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "offset" DESC) = 1""",
    "live_candle_retention": f"WITH {STATE} {newest('state', LIVE_BARS)}",
    "closed_candle_stream": f"WITH {CANDLES} SELECT * FROM candles",
    "closed_candle_resume": f"WITH {CANDLES} SELECT * FROM candles",
    "closed_candle_features": f"WITH {CANDLES}, {so_far('candles', 'feat')} {SERVE_SELECT}",
    "live_chart": f"""WITH {STATE}, {STORED}, merged AS (
            SELECT {COLS}, CAST(NULL AS BOOLEAN) AS is_closed FROM stored s
            WHERE NOT EXISTS (SELECT 1 FROM state l
                              WHERE l.symbol = s.symbol AND l."timestamp" = s."timestamp")
            UNION ALL SELECT {COLS}, is_closed FROM state)
        {newest('merged', CHART_BARS)}""",
    "live_state_unkeyed": f"WITH {UNKEYED_STATE} SELECT * FROM state",
    "live_latest_unkeyed": f"""WITH {UNKEYED} SELECT * FROM arrived
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC, "partition" DESC, "offset" DESC) = 1""",
    "live_retention_unkeyed": f"WITH {UNKEYED_STATE} {newest('state', LIVE_BARS)}",
    "topic_once": f"WITH {UNKEYED} SELECT * EXCLUDE (time) FROM arrived",
    "ticker_latest": f"""WITH {TICKERS} SELECT * FROM tickers
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "offset" DESC) = 1""",
    "gbt_split_counts": f"""WITH {CANDLES}, {TRAINING_SET},
        timed AS (SELECT CAST(epoch("timestamp") AS BIGINT) AS ts_unix FROM training),
        cut AS (SELECT quantile_disc(ts_unix, 0.8) AS split_time FROM timed)
        SELECT count(*) FILTER (WHERE ts_unix <= split_time) AS n_train,
               count(*) FILTER (WHERE ts_unix > split_time) AS n_test, max(split_time) AS split_at
        FROM timed, cut""",
}
