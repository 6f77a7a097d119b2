"""Streams over the topic: each keeps a small keyed table up to date.

State lives in Spark's state store (RocksDB) in the checkpoint folder and is read back through
the state data source: what a query shows is what a restarted stream goes on from. A message
counts whenever it arrives, so there is no watermark and no late-data rule; what arrived last
is decided by ``sources.arrival``, and a record that is delivered again changes nothing.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.newest import newest_n
from candlemill.schemas import CANDLE_COLS, CANDLE_SCHEMA, KEY, LIVE_BARS
from candlemill.sinks.candle_table import CandleTable
from candlemill.sinks.files import exists
from candlemill.sources.arrival import marks, with_arrival
from candlemill.sources.feed import decode_klines, demux_tickers
from candlemill.streaming.retention import NewestRows

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: The stored table as the stream keeps it: candles, and when their message arrived.
STORED_SCHEMA = T.StructType([*CANDLE_SCHEMA, T.StructField("arrival", T.DecimalType(38, 0))])

#: Groups of bar times per symbol that retention keeps apart, so a hot symbol is no single task.
SALTS = 16

_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def triggered(writer, every):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _ignore(changes, batch_id):
    """State is the result; changed rows go nowhere."""
    changes.write.format("noop").mode("overwrite").save()


class _Kept:
    """A stream whose result is its state.

    ``changes(rows, batch_id)``, where given, gets the rows each micro-batch changed.
    """

    def __init__(self, spark, checkpoint, schema, changes=None):
        self.spark, self.checkpoint, self.schema = spark, checkpoint, schema
        self.changes = changes or _ignore

    def start(self, stream, every=None):
        """Starts the stream: with what is available now, or, with a time such as
        ``"10 seconds"``, for as long as it is left running."""
        rows = self._rows(with_arrival(stream.select(*self.schema.fieldNames())))
        writer = rows.writeStream.outputMode("update").foreachBatch(self.changes)
        writer = triggered(writer.option("checkpointLocation", self.checkpoint), every)
        # A stream takes its settings when it starts; others of the session keep theirs.
        before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, ROCKSDB)
        try:
            return writer.start()
        finally:
            self.spark.conf.unset(_PROVIDER) if before is None else self.spark.conf.set(_PROVIDER, before)

    def run(self, stream):
        """Feeds the state and returns what it holds."""
        self.start(stream).awaitTermination()
        return self.read()

    def _state(self, **options):
        reader = self.spark.read.format("statestore")
        for key, value in options.items():
            reader = reader.option(key, value)
        return reader.load(self.checkpoint)

    def read(self):
        """What the state held after the last finished micro-batch."""
        if not exists(self.spark, f"{self.checkpoint}/commits/0"):
            return self.spark.createDataFrame([], self.schema)
        return self._read().select(*self.schema.fieldNames())


class LastArrived(_Kept):
    """Per key the message that arrived last, by an aggregation in update mode.

    Tasks reduce their rows before the shuffle, so a hot key sends one row per task.
    """

    def __init__(self, spark, checkpoint, schema, keys, changes=None):
        super().__init__(spark, checkpoint, schema, changes)
        self.keys = keys
        self.rest = [c for c in schema.fieldNames() if c not in keys]

    def _rows(self, rows):
        last = F.max_by(F.struct(*self.rest), "arrival").alias("last")
        return rows.groupBy(*self.keys).agg(last).select(*self.keys, "last.*")

    def _read(self):
        rows = self._state()
        # The buffer of the aggregation: the value it holds, then what it is ordered by.
        held = rows.schema["value"].dataType.fieldNames()[0]
        return rows.select(*[F.col("key")[k].alias(k) for k in self.keys], F.col("value")[held].alias("last")).select(
            *self.keys, "last.*"
        )


class Retained(_Kept):
    """The ``n`` newest candles of each symbol, each as it arrived last.

    State is kept per symbol and group of bar times, ``n`` rows in each at most, so it stays
    bounded and a symbol's messages spread over ``SALTS`` tasks; the last cut is made on reading.
    """

    def __init__(self, spark, checkpoint, schema, n=LIVE_BARS, changes=None):
        super().__init__(spark, checkpoint, schema, changes)
        self.n = n

    def _rows(self, rows):
        rest = [c for c in self.schema.fieldNames() if c not in KEY]
        keyed = rows.select(
            "symbol",
            F.pmod(F.xxhash64("timestamp"), F.lit(SALTS)).cast("int").alias("salt"),
            F.col("timestamp").cast("string").alias("bar"),
            F.lpad(F.col("arrival").cast("string"), 38, "0").alias("arrival"),
            F.to_json(F.struct(*rest), _TIMES).alias("body"),
        )
        kept = keyed.groupBy("symbol", "salt").transformWithStateInPandas(
            NewestRows(self.n), "symbol string, bar string, body string", "Update", "None"
        )
        return self._open(kept)

    def _open(self, rows):
        rest = T.StructType([f for f in self.schema if f.name not in KEY])
        bar = F.col("bar").cast("timestamp_ntz").alias("timestamp")
        return rows.select("symbol", bar, F.from_json("body", rest, _TIMES).alias("v")).select(*KEY, "v.*")

    def _read(self):
        held = self._state(stateVarName=NewestRows.NAME).select(
            F.col("key")["symbol"].alias("symbol"),
            F.col("user_map_key")["bar"].alias("bar"),
            F.col("user_map_value")["body"].alias("body"),
        )
        return newest_n(self._open(held), self.n)


def live_candles(spark, checkpoint, stream, changes=None):
    """Per (symbol, timestamp) the message that arrived last."""
    return LastArrived(spark, checkpoint, stream.schema, KEY, changes)


def latest_candle(spark, checkpoint, stream, changes=None):
    """Per symbol the candle message that arrived last, whatever its time."""
    return LastArrived(spark, checkpoint, stream.schema, ["symbol"], changes)


def latest_ticker(spark, checkpoint, stream, changes=None):
    """Per symbol the ticker that arrived last."""
    return LastArrived(spark, checkpoint, stream.schema, ["symbol"], changes)


def retained_candles(spark, checkpoint, stream, n=LIVE_BARS, changes=None):
    """As ``live_candles``, for the ``n`` newest times of each symbol."""
    return Retained(spark, checkpoint, stream.schema, n, changes)


class ClosedCandles:
    """The stored table fed by closed candles, as they come.

    Each micro-batch is committed to a ``CandleTable`` that keeps arrivals: of equal keys the
    one that arrived last counts, so a batch delivered again, a topic replayed from its start
    and a stream that goes on after the table's marks all end in the same table. Seeded and
    fetched candles have no arrival and give way to any that has one.
    """

    def __init__(self, spark, path):
        self.table = CandleTable(spark, path, STORED_SCHEMA)

    def write(self, batch, batch_id):
        """``foreachBatch`` target."""
        self.table.upsert(with_arrival(batch.filter("is_closed")).select(*CANDLE_COLS, "arrival"))

    def start(self, stream, checkpoint, every=None):
        writer = stream.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return triggered(writer, every).start()

    def run(self, stream, checkpoint):
        self.start(stream, checkpoint).awaitTermination()
        return self.read()

    def read(self):
        return self.table.read().select(*CANDLE_COLS)

    def marks(self):
        """How far the table has got in each topic partition, for ``sources.arrival.after``.

        Taken once, as the stream that starts from the marks changes the table; one row per
        partition reaches the driver.
        """
        found = marks(self.table.read())
        return self.table.spark.createDataFrame(found.collect(), found.schema)


def kline_stream(topic, symbols):
    return decode_klines(topic, symbols)


def ticker_stream(feed):
    return demux_tickers(feed)


def append_stream(rows, path, checkpoint):
    """Writes a stateless stream's rows as Parquet, exactly once, and waits for the end."""
    query = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
