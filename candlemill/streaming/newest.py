"""Streams that keep what is shown of the newest candles: their features and the chart.

Both work in micro-batches on the changes alone and on the newest rows per symbol, never on the
history; the windows inside a batch run over time slices, so a hot symbol is no single task.
Results, the rows carried on and the checkpoint share one folder, as none is of use alone.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.features import SERVE_HISTORY, serve_features_so_far
from candlemill.operators.merge import last_arrived, live_over_stored
from candlemill.operators.newest import latest_timestamp, newest_n
from candlemill.operators.slices import SLICE_BARS
from candlemill.schemas import CANDLE_COLS, CANDLE_SCHEMA, KEY, LIVE_BARS, MINUTE_MS
from candlemill.sinks.files import exists
from candlemill.sinks.generations import Generations
from candlemill.sources.arrival import with_arrival
from candlemill.streaming.live import LastArrived, triggered

#: A chart row: stored candles have no ``is_closed``.
CHART_SCHEMA = T.StructType([*CANDLE_SCHEMA, T.StructField("is_closed", T.BooleanType())])


class ClosedFeatures:
    """Serving features of each closed candle, computed once, when it comes.

    The last ``SERVE_HISTORY`` closed candles of each symbol are carried from batch to batch.
    Candles count in the order of their times: one that is not newer than the newest its symbol
    had in an earlier batch is left out, as its turn is over (the stored table takes it still).
    Within a batch the message that arrived last counts. So however the messages are dealt to
    batches, candles that come in order get the features ``serve_features_so_far`` gives them.
    """

    def __init__(self, spark, path, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
        self.spark, self.path = spark, path
        self.interval_ms, self.slice_bars = interval_ms, slice_bars
        self.history = Generations(spark, f"{path}/history", CANDLE_SCHEMA)

    def _features(self, rows):
        return serve_features_so_far(rows, self.interval_ms, self.slice_bars)

    def write(self, batch, batch_id):
        """``foreachBatch`` target; a batch that is run again writes the same once more."""
        closed = with_arrival(batch.filter("is_closed AND symbol IS NOT NULL AND timestamp IS NOT NULL"))
        closed = last_arrived(closed.select(*CANDLE_COLS, "arrival"), "arrival").select(*CANDLE_COLS)
        held = self.history.before(batch_id)
        past = F.col("max_timestamp").isNull() | (F.col("timestamp") > F.col("max_timestamp"))
        fresh = closed.join(latest_timestamp(held), "symbol", "left").filter(past).select(*CANDLE_COLS)
        rows = held.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
        done = self._features(rows).filter("_fresh").drop("_fresh")
        path = f"{self.path}/features/batch={batch_id}"
        done.write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(done.schema).parquet(path).select(*CANDLE_COLS)
        self.history.put(batch_id, newest_n(held.unionByName(written), SERVE_HISTORY))

    def start(self, stream, every=None):
        writer = stream.writeStream.foreachBatch(self.write)
        return triggered(writer.option("checkpointLocation", f"{self.path}/checkpoint"), every).start()

    def run(self, stream):
        self.start(stream).awaitTermination()
        return self.read()

    def read(self):
        """All features so far."""
        schema = self._features(self.spark.createDataFrame([], CANDLE_SCHEMA)).schema
        if not exists(self.spark, f"{self.path}/features"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/features").select(*schema.fieldNames())


class LiveChart:
    """The ``n`` newest candles of every symbol, stored and live, kept up to date by changes.

    The live candles a micro-batch changed are written over those shown; the stored side is
    read anew each time through ``newest`` of its table, which prunes to few months. A live
    candle that left the chart has ``n`` newer ones and never returns, so the live rows shown
    are all that has to be carried. ``table`` is a ``CandleTable``.
    """

    def __init__(self, spark, path, table, n=LIVE_BARS):
        self.spark, self.path, self.table, self.n = spark, path, table, n
        self.shown = Generations(spark, f"{path}/chart", CHART_SCHEMA)

    def write(self, changes, batch_id):
        """Takes the candles a micro-batch changed, as ``LastArrived`` hands them on."""
        columns = CHART_SCHEMA.fieldNames()
        changes = newest_n(changes.withColumn("is_closed", F.coalesce("is_closed", F.lit(False))).select(*columns), self.n)
        live = self.shown.before(batch_id).filter("is_closed IS NOT NULL")
        live = live.join(changes.select(*KEY), KEY, "left_anti").unionByName(changes)
        stored = self.table.newest(self.n).select(*CANDLE_COLS)
        self.shown.put(batch_id, live_over_stored(stored, live, self.n))

    def _kept(self, stream):
        return LastArrived(self.spark, f"{self.path}/checkpoint", stream.schema, KEY, self.write)

    def start(self, stream, every=None):
        return self._kept(stream).start(stream, every)

    def run(self, stream):
        self.start(stream).awaitTermination()
        return self.read()

    def read(self):
        """The chart after the last finished batch; the stored candles before the first."""
        shown = self.shown.read()
        if shown.isEmpty():
            stored = newest_n(self.table.newest(self.n).select(*CANDLE_COLS), self.n)
            return stored.withColumn("is_closed", F.lit(None).cast("boolean"))
        return shown
