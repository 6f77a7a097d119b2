"""The stored candles: a Parquet table partitioned by symbol and month.

``<path>/part_symbol=<s>/part_month=<yyyy-MM>``  candles of one month of one symbol
``<path>/_staged``                               new content of the parts a commit replaces
``<path>/_faults``                               counts of parts that fail or failed a check

A commit writes the new content of the parts it touches to ``_staged``, then Spark's dynamic
partition overwrite puts it in place, then ``_staged`` goes. A job that dies before ``_staged``
is whole has changed nothing; one that dies later left it whole, and the next commit first puts
it in place once more, which changes nothing that was in place already. One job commits at a
time. Readers that run while parts are replaced may have to read again.

The pass that writes the parts also counts candles without price and repeated keys, so the
quality gate reads no candles: every part was checked when it was written. Only where a count is
not zero are the staged parts read once more, to note which of them fail.
"""

from pyspark.sql import Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators import merge, quality
from candlemill.schemas import CANDLE_SCHEMA, KEY
from candlemill.session import scratch_path
from candlemill.sinks.files import exists, remove

PARTS = ["part_symbol", "part_month"]
FAULTS = ["n_null_prices", "n_duplicate_keys"]
_FAULT_SCHEMA = "n_rows long, n_null_prices long, n_duplicate_keys long, part_symbol string, part_month string"


def _folders(symbol):
    """The folder name of a symbol. Spark reads an empty name back as NULL, hence the prefix."""
    return F.concat(F.lit("s-"), symbol)


def _with_parts(rows):
    month = F.substring(F.col("timestamp").cast("string"), 1, 7)
    return rows.withColumns({"part_symbol": _folders(F.col("symbol")), "part_month": month})


class CandleTable:
    """Rows are keyed by (symbol, timestamp). ``schema`` may hold further columns; with an
    ``arrival`` column, of equal keys the row that arrived last counts, whenever it is committed.
    """

    def __init__(self, spark, path, schema=CANDLE_SCHEMA):
        self.spark, self.path = spark, path
        self.staging, self.noted = f"{path}/_staged", f"{path}/_faults"
        # Read back, every column may be NULL as far as Parquet knows.
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.by_arrival = "arrival" in self.schema.fieldNames()

    def _table(self):
        schema = T.StructType([*self.schema, *[T.StructField(c, T.StringType()) for c in PARTS]])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _within(self, parts):
        """The rows of the given parts; where Spark broadcasts them, only their folders are read."""
        # A condition that always holds tells Spark that the parts select few folders.
        return self._table().join(parts.filter(F.col("part_month") > ""), PARTS, "left_semi")

    def read(self, symbols=None):
        """The whole table, or the folders of the given symbols."""
        self._recover()
        rows = self._table()
        if symbols is not None:
            rows = rows.filter(F.col("part_symbol").isin([f"s-{s}" for s in symbols]))
        return rows.select(*self.schema.fieldNames())

    def newest_parts(self, n):
        """The newest months of each symbol that together hold its ``n`` newest candles.

        Keys are unique, so row counts tell how far back to go, and a symbol with few candles a
        month simply takes more months. Counting reads no column, only the files' row counts.
        """
        counts = self._table().groupBy(*PARTS).agg(F.count("*").alias("n_rows"))
        later = W.partitionBy("part_symbol").orderBy(F.desc("part_month")).rowsBetween(W.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n_rows").over(later), F.lit(0))
        return counts.withColumn("before", before).filter(F.col("before") < n).select(*PARTS)

    def newest(self, n):
        """A superset of the ``n`` newest candles per symbol, from the fewest months."""
        self._recover()
        return self._within(self.newest_parts(n)).select(*self.schema.fieldNames())

    def _read_staged(self):
        schema = T.StructType([*self.schema, *[T.StructField(c, T.StringType()) for c in PARTS]])
        return self.spark.read.schema(schema).parquet(self.staging)

    def _replace(self, rows, path):
        """Puts ``rows`` in place of the parts they belong to; other parts stay."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PARTS).parquet(path)

    def _put(self):
        """Puts the staged parts in place of those of the table."""
        self._replace(self._read_staged(), self.path)
        remove(self.spark, self.staging)

    def _recover(self):
        """Ends a commit that died after its parts were staged."""
        if exists(self.spark, f"{self.staging}/_SUCCESS"):
            self._note_faults()
            self._put()

    def _checked(self, rows, seen):
        """The rows as they are written, counted by ``seen`` in the stage that writes them.

        One task per folder and none of its months in two: one file per month and symbol. A
        folder's rows lie in order of time, so a repeated key follows its equal.
        """
        within = W.partitionBy(*PARTS).orderBy("timestamp")
        again = F.col("timestamp") == F.lag("timestamp").over(within)
        counted = rows.repartition(*PARTS).withColumn("_again", again)
        counted = counted.observe(
            seen,
            F.count_if(quality.lacks_price()).alias("n_null_prices"),
            F.count_if("_again").alias("n_duplicate_keys"),
        )
        return counted.drop("_again").sortWithinPartitions(*PARTS, "timestamp")

    def _commit(self, rows):
        seen = Observation()
        self._checked(rows, seen).write.mode("overwrite").partitionBy(*PARTS).parquet(self.staging)
        if any(seen.get[c] for c in FAULTS) or exists(self.spark, self.noted):
            self._note_faults()
        self._put()

    def _noted(self):
        if not exists(self.spark, self.noted):
            return self.spark.createDataFrame([], _FAULT_SCHEMA)
        return self.spark.read.schema(_FAULT_SCHEMA).parquet(self.noted)

    def _note_faults(self):
        """Notes the staged parts that fail a check, and those that failed one before."""
        counts = self._read_staged().groupBy(*PARTS).agg(
            F.count("*").alias("n_rows"),
            F.count_if(quality.lacks_price()).alias("n_null_prices"),
            (F.count("*") - F.count_distinct("timestamp")).alias("n_duplicate_keys"),
        )
        before = self._noted().select(*PARTS, F.lit(True).alias("before"))
        failing = F.greatest(*FAULTS) > 0
        # Written elsewhere first, as the notes are read for it.
        path = scratch_path(self.spark, "faults")
        counts.join(before, PARTS, "left").filter(failing | F.col("before")).drop("before").write.parquet(path)
        self._replace(self.spark.read.schema(_FAULT_SCHEMA).parquet(path), self.noted)

    def faults(self):
        """Months of symbols that fail a check, with their rows, those without price and those
        of a key that is there already."""
        self._recover()
        failing = self._noted().filter(F.greatest(*FAULTS) > 0)
        return failing.select(
            F.expr("substring(part_symbol, 3)").alias("symbol"), F.col("part_month").alias("month"), "n_rows", *FAULTS
        )

    def gate(self):
        """Raises unless the table holds candles and all its parts passed their checks.

        Reads the notes of commits alone. Parts put there by other means are checked by
        ``quality.gate`` on ``read()``.
        """
        totals = self.faults().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FAULTS]).first()
        if self._table().isEmpty():
            raise quality.QualityError("no candles")
        quality.refuse(**totals.asDict())

    def _batch(self, rows):
        """The batch, written once, as a commit reads it more than once."""
        keyed = rows.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
        batch = _with_parts(keyed.select(*self.schema.fieldNames()))
        path = scratch_path(self.spark, "commit")
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def upsert(self, rows, order=None):
        """Commits ``rows`` over the table; of equal keys the last by ``order`` counts
        (see ``merge``), in a table with an ``arrival`` column always the last by that.

        Rows without a key are left out. Committing a batch again changes nothing.
        """
        self._recover()
        order = "arrival" if self.by_arrival else order
        batch = self._batch(merge.one_per_key(rows, order, merge.last_arrived))
        if batch.isEmpty():
            return
        stored = self._within(batch.select(*PARTS).distinct())
        if self.by_arrival:
            merged = merge.last_arrived(stored.unionByName(batch), "arrival", KEY)
        else:
            merged = stored.join(batch.select(*KEY), KEY, "left_anti").unionByName(batch)
        self._commit(merged.select(*self.schema.fieldNames(), *PARTS))

    def insert_ignore(self, rows, order=None):
        """Commits the rows whose key the table lacks; of equal keys the first by ``order``.

        Only months that gain a candle are rewritten, so a batch of known keys commits nothing.
        Returns the rows that were added.
        """
        self._recover()
        batch = self._batch(merge.one_per_key(rows, order, merge.first_arrived))
        stored = self._within(batch.select(*PARTS).distinct())
        fresh = self._batch(batch.join(stored.select(*KEY), KEY, "left_anti"))
        if not fresh.isEmpty():
            touched = self._within(fresh.select(*PARTS).distinct())
            self._commit(touched.unionByName(fresh).select(*self.schema.fieldNames(), *PARTS))
        return fresh.select(*self.schema.fieldNames())
