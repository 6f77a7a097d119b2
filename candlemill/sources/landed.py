"""Topic records landed as Parquet files, for replay and for runs without a broker."""

from pyspark.sql import types as T

from candlemill.schemas import TOPIC_SCHEMA


def read_landed(spark, path, files_per_trigger=None):
    """The columns of ``TOPIC_SCHEMA`` that the landed files have.

    A topic landed without partition and time has one partition, ordered by its offsets.
    """
    columns = spark.read.parquet(path).columns
    reader = spark.readStream.schema(T.StructType([f for f in TOPIC_SCHEMA if f.name in columns]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
