"""A bounded table that every micro-batch of a stream writes anew.

For results that are small whatever the stream's length, such as the newest rows per symbol. A
batch starts from what the batch before it wrote and never changes that, so one that died is
simply run again.
"""

from candlemill.sinks.files import exists, names, remove


class Generations:
    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def _finished(self):
        found = (n for n in names(self.spark, self.path) if n.isdigit())
        return sorted(int(n) for n in found if exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _read(self, ids):
        if not ids:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{ids[-1]}")

    def before(self, batch_id):
        """What ``batch_id`` starts from."""
        return self._read([i for i in self._finished() if i < batch_id])

    def put(self, batch_id, rows):
        """The outcome of ``batch_id``; the one before it stays, in case this batch is run again."""
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        kept = [i for i in self._finished() if i < batch_id][-1:] + [batch_id]
        for i in set(self._finished()) - set(kept):
            remove(self.spark, f"{self.path}/{i}")

    def read(self):
        """The outcome of the last finished batch."""
        return self._read(self._finished())
