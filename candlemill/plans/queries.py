"""The registered queries: each reads the given tables and returns one DataFrame."""

from functools import reduce

from pyspark.sql import functions as F

from candlemill.functions.timefn import from_epoch_ms
from candlemill.ml import direction
from candlemill.operators import features, gaps, merge, metrics, newest, quality, signals, split
from candlemill.operators.slices import fill_both_ways
from candlemill.plans import inputs as I
from candlemill.schemas import CANDLE_COLS, KEY
from candlemill.session import scratch_path
from candlemill.sinks import layout
from candlemill.sinks.candle_table import CandleTable
from candlemill.sinks.csvfiles import write_csv
from candlemill.sources import arrival, csvfiles, feed, rest
from candlemill.sources.canonical import canonical
from candlemill.sources.landed import read_landed
from candlemill.streaming import live
from candlemill.streaming.newest import ClosedFeatures, LiveChart

BACKTEST_LIMIT = 20
CHART_BARS = 100
STATS = ["rolling_avg_close_5", "rolling_avg_15m", "rolling_avg_1h", "volatility_15m"]
RATIOS = ["price_change_pct", "price_change_pct_guarded", "hl_spread"]


def rounded(df, *names, digits=8):
    """Floating results at eight decimals, for comparison across engines."""
    chosen = [c for c in names if c in df.columns]
    return df.withColumns({c: F.round(c, digits) for c in chosen})


def _shown(df):
    return rounded(df, *STATS, *RATIOS)


def _shown_wide(df):
    """Prices near 10^5: engines agree on fewer decimals than for small prices."""
    averages = [c for c in STATS if c != "volatility_15m"]
    wide = rounded(rounded(df, *averages, digits=7), "volatility_15m", digits=5)
    return rounded(wide, *RATIOS)


# --- sources -----------------------------------------------------------------


def csv_candle_scan(spark, sf_dir):
    return csvfiles.read_candles(spark, _csv_folder(spark, sf_dir))


def symbol_from_path(spark, sf_dir):
    scanned = csvfiles.scan_csv(spark, _csv_folder(spark, sf_dir))
    return scanned.groupBy("symbol").agg(F.count("*").alias("n_rows"))


def _csv_folder(spark, sf_dir):
    """Yearly files, one symbol monthly, and notes whose name carries no symbol."""
    path = scratch_path(spark, "csv")
    candles = I.candles(spark, sf_dir)
    monthly = F.col("symbol") == "VIEW"
    write_csv(candles.filter(~monthly), path, "1year")
    write_csv(candles.filter(monthly), path, "1month")
    notes = candles.filter(F.col("symbol") == "ERROR").withColumn("file", F.lit("notes.csv"))
    notes = notes.drop("symbol").withColumn("timestamp", F.col("timestamp").cast("string"))
    notes.write.mode("append").partitionBy("file").option("header", True).csv(path)
    return path


def csv_rejects(spark, sf_dir):
    """Rows of files in which the times of midnight bars were damaged."""
    path = scratch_path(spark, "csv-damaged")
    candles = I.candles(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("string"))
    midnight = F.col("timestamp").like("% 00:00:00")
    damaged = candles.withColumn("timestamp", F.when(midnight, "n/a").otherwise(F.col("timestamp")))
    named = damaged.withColumn("file", F.concat("symbol", F.lit("_1m_1year.csv"))).drop("symbol")
    named.write.partitionBy("file").option("header", True).csv(path)
    rows = csvfiles.rejected_rows(spark, path.replace("\\", "/"))
    return rows.groupBy("symbol", "reason").agg(F.count("*").alias("n_rows"))


def canonical_candles(spark, sf_dir):
    text = I.candles(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in CANDLE_COLS])
    return canonical(text)


def rest_page_decode(spark, sf_dir):
    return rest.decode_pages(I.rest_pages(I.candles(spark, sf_dir)))


def rest_rejects(spark, sf_dir):
    """Pages of which those of one symbol are cut short and those of another lack open times."""
    pages = I.rest_pages(I.candles(spark, sf_dir))
    value, symbol = F.col("value"), F.col("symbol")
    damaged = F.when(symbol == "VIEW", F.substring(value, 1, 40)).when(
        symbol == "CLICK", F.regexp_replace(value, r'\[\d+,"', '[null,"')
    )
    rows = rest.rejected_pages(pages.withColumn("value", F.coalesce(damaged, value)))
    return rows.groupBy("symbol", "reason").agg(F.count("*").alias("n_rows"))


# --- newest rows -------------------------------------------------------------


def latest_n_candles(spark, sf_dir):
    return newest.newest_n(I.candles(spark, sf_dir), signals.HISTORY_ROWS)


def latest_n_candles_wide(spark, sf_dir):
    return newest.newest_n(I.supplier_candles(spark, sf_dir), 12)


def latest_timestamp(spark, sf_dir):
    return newest.latest_timestamp(I.candles(spark, sf_dir))


def load_report(spark, sf_dir):
    return quality.load_report(I.candles(spark, sf_dir))


# --- features ----------------------------------------------------------------


def candle_lags(spark, sf_dir):
    return features.lags(I.candles(spark, sf_dir), I.HOUR_MS)


def candle_rolling_train(spark, sf_dir):
    return _shown(features.rolling(I.candles(spark, sf_dir), "train", I.HOUR_MS))


def candle_rolling_serve(spark, sf_dir):
    return _shown(features.rolling(I.candles(spark, sf_dir), "serve", I.HOUR_MS))


def candle_returns(spark, sf_dir):
    """Bars of one trade open at 0 here, which a ratio must survive."""
    quiet = F.col("number_of_trades") == 1
    candles = I.candles(spark, sf_dir)
    return _shown(features.returns(candles.withColumn("open", F.when(quiet, 0.0).otherwise(F.col("open")))))


def candle_features_train(spark, sf_dir):
    return _shown(features.features(I.candles(spark, sf_dir), "train", I.HOUR_MS))


def _laid_out(spark, sf_dir):
    path = scratch_path(spark, "layout")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    return layout.write_layout(I.candles(spark, sf_dir), name, path, buckets=16, interval_ms=I.HOUR_MS, slice_bars=168)


def layout_features_train(spark, sf_dir):
    """Training features from the bucketed layout, without a shuffle."""
    return _shown(features.features(_laid_out(spark, sf_dir), "train", I.HOUR_MS))


def layout_newest(spark, sf_dir):
    return layout.newest_of(_laid_out(spark, sf_dir), CHART_BARS)


def candle_features_serve(spark, sf_dir):
    return _shown(features.features(I.candles(spark, sf_dir), "serve", I.HOUR_MS))


def candle_features_so_far(spark, sf_dir):
    """Serving features that look at no later candle; quiet bars have no close."""
    busy = F.col("number_of_trades") > 1
    candles = I.candles(spark, sf_dir).withColumn("close", F.when(busy, F.col("close")))
    return _shown(features.serve_features_so_far(candles, I.HOUR_MS))


def candle_features_reg12(spark, sf_dir):
    return _shown(features.features(I.candles(spark, sf_dir), "reg12", I.HOUR_MS))


def candle_features_train_wide(spark, sf_dir):
    return _shown_wide(features.features(I.supplier_candles(spark, sf_dir), "train", I.MONTH_MS, 24))


def candle_features_serve_wide(spark, sf_dir):
    return _shown_wide(features.features(I.supplier_candles(spark, sf_dir), "serve", I.MONTH_MS, 24))


def candle_training_set(spark, sf_dir):
    return _shown(features.training_set(I.candles(spark, sf_dir), I.HOUR_MS))


def null_fill_bidirectional(spark, sf_dir):
    """Closes of quiet bars (one trade) are blanked, then filled from their neighbours."""
    candles = I.candles(spark, sf_dir)
    busy = F.col("number_of_trades") > 1
    blanked = candles.withColumns({c: F.when(busy, F.col(c)) for c in ["close", "volume"]})
    return fill_both_ways(blanked, ["close", "volume"], I.HOUR_MS)


def time_split(spark, sf_dir):
    rows = features.training_set(I.candles(spark, sf_dir), I.HOUR_MS)
    rows = rows.select("symbol", "timestamp", "close", "label")
    return split.time_split(direction.stored_once(rows, "training"))


def time_split_sketched(spark, sf_dir):
    """How many rows the sketches per symbol and month stand for, and whether the split found
    from them has the wanted share of the rows before it, give or take 1 %."""
    rows = features.training_set(I.candles(spark, sf_dir), I.HOUR_MS).select("symbol", "timestamp")
    rows = direction.stored_once(rows, "training")
    found = split.sketched_quantile(split.time_sketches(rows))
    until = F.col("ts_unix") <= found.select("split_ts").scalar()
    counted = split.with_ts_unix(rows).agg(F.count_if(until).alias("n_train"), F.first(found.select("n_rows").scalar()).alias("n_rows"))
    share = F.abs(F.col("n_train") / F.col("n_rows") - F.lit(split.SPLIT_AT))
    return counted.select("n_rows", (share <= 0.01).alias("near"))


# --- merges ------------------------------------------------------------------


def _halves(spark, sf_dir):
    return I.stored_candles(spark, sf_dir), I.live_candles(spark, sf_dir)


def merge_insert_ignore(spark, sf_dir):
    return merge.insert_ignore(*_halves(spark, sf_dir))


def merge_upsert(spark, sf_dir):
    return merge.upsert(*_halves(spark, sf_dir))


def merge_upsert_last_wins(spark, sf_dir):
    """A batch with many copies per key: each tick is a one-trade candle of its bar."""
    ticks = I.since(I.events(spark, sf_dir), I.LIVE_FROM)
    same = ["open", "high", "low", "close", "volume"]
    batch = ticks.select(
        "event_id",
        F.upper("event_type").alias("symbol"),
        from_epoch_ms(I.bar_start_ms("ts", I.HOUR_MS)).alias("timestamp"),
        *[F.col("value").alias(c) for c in same],
        F.lit(1).cast("long").alias("number_of_trades"),
    )
    return merge.upsert(I.stored_candles(spark, sf_dir), batch, order="event_id")


def _table(spark, sf_dir):
    """A stored table on disk that holds the stored candles."""
    store = CandleTable(spark, scratch_path(spark, "table"))
    store.insert_ignore(I.stored_candles(spark, sf_dir))
    return store


def table_upsert_commit(spark, sf_dir):
    """The stored table after the live candles are committed over it, read back."""
    store = _table(spark, sf_dir)
    store.upsert(I.live_candles(spark, sf_dir))
    return store.read()


def table_insert_commit(spark, sf_dir):
    """The stored table after the live candles it lacks are committed, read back."""
    store = _table(spark, sf_dir)
    store.insert_ignore(I.live_candles(spark, sf_dir))
    return store.read()


def table_newest(spark, sf_dir):
    """The newest candles of the stored table, read from its newest months alone."""
    store = CandleTable(spark, scratch_path(spark, "table"))
    store.insert_ignore(I.candles(spark, sf_dir))
    return newest.newest_n(store.newest(CHART_BARS), CHART_BARS)


def table_faults(spark, sf_dir):
    """Quiet bars are stored without close, then the live candles are committed over them."""
    store = CandleTable(spark, scratch_path(spark, "table"))
    busy = F.col("number_of_trades") > 1
    store.insert_ignore(I.stored_candles(spark, sf_dir).withColumn("close", F.when(busy, F.col("close"))))
    store.upsert(I.live_candles(spark, sf_dir))
    return store.faults()


def merge_repeated_keys(spark, sf_dir):
    """A batch that gives a key several times and has no order: the greatest values win."""
    candles = I.live_candles(spark, sf_dir).select(*CANDLE_COLS)
    other = candles.withColumn("open", F.col("open") - 1)
    return merge.upsert(I.stored_candles(spark, sf_dir), candles.unionByName(other).unionByName(candles))


def live_history_merge(spark, sf_dir):
    return merge.live_over_stored(*_halves(spark, sf_dir))


def live_history_chart(spark, sf_dir):
    return merge.live_over_stored(*_halves(spark, sf_dir), n=CHART_BARS)


def candle_metrics(spark, sf_dir):
    stored, live_rows = _halves(spark, sf_dir)
    shown = merge.live_over_stored(stored, live_rows, n=CHART_BARS)
    # A symbol whose newest live bar has one trade counts as still open, one is not live at all.
    latest = newest.newest_row(live_rows).filter(F.col("symbol") != "VIEW")
    latest = latest.withColumn("is_closed", F.col("number_of_trades") > 1)
    result = metrics.candle_metrics(shown, latest)
    return rounded(result, "difference", "percentage")


# --- signals -----------------------------------------------------------------


def signal_latest(spark, sf_dir):
    symbols = I.symbol_table(spark, [I.EMPTY_SYMBOL])
    result = signals.rule_latest(I.candles(spark, sf_dir), symbols, I.NOW)
    return rounded(_shown(result), "confidence_exact")


def signal_backtest(spark, sf_dir):
    return signals.backtest(I.candles(spark, sf_dir), BACKTEST_LIMIT)


def signal_backtest_wide(spark, sf_dir):
    return signals.backtest(I.supplier_candles(spark, sf_dir), BACKTEST_LIMIT)


def signal_accuracy(spark, sf_dir):
    return rounded(signals.backtest_accuracy(I.candles(spark, sf_dir), BACKTEST_LIMIT), "accuracy")


# --- gaps and quality --------------------------------------------------------


def _tail_plan(spark, sf_dir):
    symbols = I.symbol_table(spark, [I.EMPTY_SYMBOL])
    return gaps.tail_plan(I.candles(spark, sf_dir), symbols, I.GAP_NOW_MS, I.HOUR_MS)


def gap_plan(spark, sf_dir):
    return _tail_plan(spark, sf_dir)


def gap_plan_startup(spark, sf_dir):
    symbols = I.symbol_table(spark, [I.EMPTY_SYMBOL])
    return gaps.startup_plan(I.candles(spark, sf_dir), symbols, I.HOUR_MS)


def gap_pages(spark, sf_dir):
    return gaps.page_plan(_tail_plan(spark, sf_dir), I.GAP_NOW_MS, I.HOUR_MS, I.PAGE_BARS)


def hole_pages(spark, sf_dir):
    return gaps.hole_pages(I.candles(spark, sf_dir), I.HOUR_MS, I.HOLE_PAGE_BARS)


def _fetched(spark, sf_dir):
    pages = I.rest_pages(I.candles_of(I.since(I.events(spark, sf_dir), I.LIVE_FROM)))
    return gaps.fetched_rows(I.stored_candles(spark, sf_dir), pages, I.NOW_MS, I.HOUR_MS)


def gap_backfill(spark, sf_dir):
    return I.stored_candles(spark, sf_dir).unionByName(_fetched(spark, sf_dir))


def backfill_report(spark, sf_dir):
    return merge.rows_added(_fetched(spark, sf_dir))


def missing_bars(spark, sf_dir):
    return gaps.missing_bars(I.candles(spark, sf_dir), I.HOUR_MS)


def dq_no_null_prices(spark, sf_dir):
    """Per symbol, whose closes were blanked where the symbol is VIEW and a bar has one trade."""
    blank = (F.col("symbol") == "VIEW") & (F.col("number_of_trades") == 1)
    candles = I.candles(spark, sf_dir)
    damaged = candles.withColumn("close", F.when(~blank, F.col("close")))
    checks = [
        quality.no_null_prices(damaged.filter(F.col("symbol") == s)).select(F.lit(s).alias("symbol"), "ok")
        for s in I.EVENT_SYMBOLS
    ]
    return reduce(lambda a, b: a.unionByName(b), checks)


def dq_zero_volume(spark, sf_dir):
    """Candles of rounded-down volume, so that some are zero."""
    candles = I.candles(spark, sf_dir)
    return quality.zero_volume(candles.withColumn("volume", F.floor("volume").cast("double")))


def dq_key_unique(spark, sf_dir):
    """Stored and live candles side by side repeat the keys of two days."""
    stored, live_rows = _halves(spark, sf_dir)
    return quality.duplicate_keys(stored.select(*KEY).unionByName(live_rows.select(*KEY)))


def dq_null_keys(spark, sf_dir):
    """Bars of one trade lose their symbol, bars of two their time."""
    trades = F.col("number_of_trades")
    damaged = I.candles(spark, sf_dir).withColumns(
        {"symbol": F.when(trades != 1, F.col("symbol")), "timestamp": F.when(trades != 2, F.col("timestamp"))}
    )
    return quality.null_keys(damaged)


# --- streams -----------------------------------------------------------------


def _feed(spark, sf_dir):
    """The raw feed as a stream of landed messages."""
    messages = I.feed_messages(I.events(spark, sf_dir))
    return read_landed(spark, I.landed(messages, "feed"))


def _topic(spark, sf_dir):
    """The topic the feed is published to, landed, as a stream."""
    payloads = feed.publish(I.feed_messages(I.events(spark, sf_dir)))
    return read_landed(spark, I.landed(payloads.select("offset", "value"), "topic"))


def _appended(spark, rows, name):
    return live.append_stream(rows, scratch_path(spark, name), scratch_path(spark, f"{name}-cp"))


def _kept(make, stream):
    spark = stream.sparkSession
    return make(spark, scratch_path(spark, "live-cp"), stream).run(stream)


def feed_demux_ticker(spark, sf_dir):
    return _appended(spark, feed.demux_tickers(_feed(spark, sf_dir)), "tickers")


def feed_demux_kline(spark, sf_dir):
    return _appended(spark, feed.demux_klines(_feed(spark, sf_dir)), "klines")


def feed_rejects(spark, sf_dir):
    return _appended(spark, feed.rejects(_feed(spark, sf_dir)), "rejects")


def kafka_payload_encode(spark, sf_dir):
    return _appended(spark, feed.encode(feed.demux_klines(_feed(spark, sf_dir))), "payload")


def kline_stream_decode(spark, sf_dir):
    klines = live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS)
    return _appended(spark, klines, "decoded")


def topic_rejects(spark, sf_dir):
    """The topic with some messages cut short, some times and some field names damaged."""
    payloads = feed.publish(I.feed_messages(I.events(spark, sf_dir)))
    at, value = F.col("offset"), F.col("value")
    damaged = (
        F.when(at % 97 == 0, "{bad")
        .when(at % 101 == 0, F.regexp_replace(value, r'"timestamp":"(\d+)-', '"timestamp":"$1/'))
        .when(at % 103 == 0, F.replace(value, F.lit('"high":'), F.lit('"hi":')))
        .otherwise(value)
    )
    topic = I.landed(payloads.select("offset", damaged.alias("value")), "topic-damaged")
    rows = feed.topic_rejects(read_landed(spark, topic), I.EVENT_SYMBOLS)
    return _appended(spark, rows.select("offset", "reason"), "topic-rejects")


def live_candle_state(spark, sf_dir):
    return _kept(live.live_candles, live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS))


def live_state_chart(spark, sf_dir):
    """Stored candles overlaid with the streamed state; the newest per symbol."""
    state = live_candle_state(spark, sf_dir).drop("offset")
    return merge.live_over_stored(I.stored_candles(spark, sf_dir), state, n=CHART_BARS)


def live_latest_candle(spark, sf_dir):
    return _kept(live.latest_candle, live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS))


def live_candle_retention(spark, sf_dir):
    return _kept(live.retained_candles, live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS))


def closed_candle_stream(spark, sf_dir):
    """The stored table after the stream's closed candles were committed to it."""
    klines = live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS)
    stored = live.ClosedCandles(spark, scratch_path(spark, "closed"))
    return stored.run(klines, scratch_path(spark, "closed-cp"))


def closed_candle_features(spark, sf_dir):
    """Serving features of the stream's closed candles, each computed when it comes."""
    klines = live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS)
    return _shown(ClosedFeatures(spark, scratch_path(spark, "closed-features"), I.HOUR_MS).run(klines))


def live_chart(spark, sf_dir):
    """The chart of stored and live candles after the stream's changes were written over it."""
    klines = live.kline_stream(_topic(spark, sf_dir), I.EVENT_SYMBOLS)
    return LiveChart(spark, scratch_path(spark, "chart"), _table(spark, sf_dir), CHART_BARS).run(klines)


def ticker_latest(spark, sf_dir):
    return _kept(live.latest_ticker, live.ticker_stream(_feed(spark, sf_dir)))


def _unkeyed(spark, sf_dir):
    """The topic over several partitions without keys, created anew before its last records."""
    payloads = feed.publish(I.feed_messages(I.events(spark, sf_dir)))
    topic = I.landed(I.unkeyed(payloads), "topic-unkeyed")
    return read_landed(spark, topic)


def live_state_unkeyed(spark, sf_dir):
    """Per bar the message that arrived last, where offsets alone don't say which one did."""
    return _kept(live.live_candles, live.kline_stream(_unkeyed(spark, sf_dir), I.EVENT_SYMBOLS))


def live_latest_unkeyed(spark, sf_dir):
    return _kept(live.latest_candle, live.kline_stream(_unkeyed(spark, sf_dir), I.EVENT_SYMBOLS))


def live_retention_unkeyed(spark, sf_dir):
    return _kept(live.retained_candles, live.kline_stream(_unkeyed(spark, sf_dir), I.EVENT_SYMBOLS))


def topic_once(spark, sf_dir):
    """Candle messages of a topic that lands every fifth record twice, each of them once."""
    payloads = I.unkeyed(feed.publish(I.feed_messages(I.events(spark, sf_dir))))
    twice = payloads.withColumn("again", F.explode(F.when(F.col("offset") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    topic = read_landed(spark, I.landed(twice.drop("again"), "topic-twice"))
    klines = live.kline_stream(arrival.one_delivery(topic), I.EVENT_SYMBOLS)
    return _appended(spark, klines.drop("time"), "once")


def closed_candle_resume(spark, sf_dir):
    """The stored table fed in two runs: the second one has a checkpoint of its own and a topic
    whose older records have expired, and goes on after what the table has."""
    messages = I.unkeyed(feed.publish(I.feed_messages(I.events(spark, sf_dir))))
    messages = spark.read.schema(messages.schema).parquet(I.landed(messages, "topic-whole"))
    stored = live.ClosedCandles(spark, scratch_path(spark, "resumed"))
    early, late = (F.col("time") <= F.lit(t).cast("timestamp_ntz") for t in (I.FIRST_RUN_UNTIL, I.EXPIRED_UNTIL))
    for kept in (messages.filter(early), messages.filter(~late)):
        topic = read_landed(spark, I.landed(kept, "topic-part"))
        fresh = arrival.after(topic, stored.marks())
        stored.run(live.kline_stream(fresh, I.EVENT_SYMBOLS), scratch_path(spark, "resumed-cp"))
    return stored.read()


# --- models ------------------------------------------------------------------


def gbt_train(spark, sf_dir):
    """Retrains on everything, saves, loads, and reports the loaded model's importances."""
    model = direction.train(I.candles(spark, sf_dir), I.HOUR_MS)
    path = scratch_path(spark, "model")
    direction.save(model, path)
    return direction.importances(spark, direction.load(path), features.TRAIN_INPUTS)


def gbt_split_counts(spark, sf_dir):
    """Rows on either side of the split the evaluation uses, and its time."""
    rows = features.training_set(I.candles(spark, sf_dir), I.HOUR_MS).select("timestamp", "label")
    parts = split.time_split(direction.stored_once(rows, "training"), exact=True)
    return parts.agg(
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
        F.max(F.when(F.col("is_train"), F.col("ts_unix"))).alias("split_at"),
    )


def gbt_accuracy(spark, sf_dir):
    candles = I.candles(spark, sf_dir)
    _, report = direction.train_and_evaluate(
        candles, exact=True, interval_ms=I.HOUR_MS
    )
    return report


def gbt_score(spark, sf_dir):
    candles = I.candles(spark, sf_dir)
    model = direction.train(candles, I.HOUR_MS)
    path = scratch_path(spark, "model")
    direction.save(model, path)
    symbols = I.symbol_table(spark, [I.EMPTY_SYMBOL])
    return direction.predict_latest(candles, symbols, I.NOW, direction.load_first([path]))


def gbt_regression(spark, sf_dir):
    """The regressor's prediction of the close after each symbol's newest candle."""
    candles = I.candles(spark, sf_dir)
    model = direction.train_regressor(candles, I.HOUR_MS)
    recent = newest.newest_n(candles, signals.HISTORY_ROWS)
    rows = newest.newest_row(features.reg12_features(recent, slice_bars=None))
    return model.transform(rows).select("symbol", "timestamp", "close", "prediction")


QUERIES = {
    f.__name__: f
    for f in [
        csv_candle_scan,
        csv_rejects,
        symbol_from_path,
        canonical_candles,
        rest_page_decode,
        rest_rejects,
        latest_n_candles,
        latest_n_candles_wide,
        latest_timestamp,
        load_report,
        candle_lags,
        candle_rolling_train,
        candle_rolling_serve,
        candle_returns,
        candle_features_train,
        layout_features_train,
        layout_newest,
        candle_features_serve,
        candle_features_so_far,
        candle_features_reg12,
        candle_features_train_wide,
        candle_features_serve_wide,
        candle_training_set,
        null_fill_bidirectional,
        time_split,
        time_split_sketched,
        merge_insert_ignore,
        merge_upsert,
        merge_upsert_last_wins,
        merge_repeated_keys,
        table_upsert_commit,
        table_insert_commit,
        table_newest,
        table_faults,
        live_history_merge,
        live_history_chart,
        candle_metrics,
        signal_latest,
        signal_backtest,
        signal_backtest_wide,
        signal_accuracy,
        gap_plan,
        gap_plan_startup,
        gap_pages,
        hole_pages,
        gap_backfill,
        backfill_report,
        missing_bars,
        dq_no_null_prices,
        dq_zero_volume,
        dq_key_unique,
        dq_null_keys,
        feed_demux_ticker,
        feed_demux_kline,
        feed_rejects,
        kafka_payload_encode,
        kline_stream_decode,
        topic_rejects,
        live_candle_state,
        live_state_chart,
        live_latest_candle,
        live_candle_retention,
        closed_candle_stream,
        closed_candle_resume,
        closed_candle_features,
        live_chart,
        ticker_latest,
        live_state_unkeyed,
        live_latest_unkeyed,
        live_retention_unkeyed,
        topic_once,
        gbt_split_counts,
        gbt_train,
        gbt_accuracy,
        gbt_score,
        gbt_regression,
    ]
}
