"""Topic reader. Needs the Kafka connector on the class path."""

from pyspark.sql import functions as F

from candlemill.schemas import TOPIC


def read_topic(spark, servers, topic=TOPIC, starting="earliest"):
    """The topic as ``(partition, offset, time, value)``, read from the start unless a checkpoint
    says otherwise.

    ``starting`` may be the text of ``arrival.starting_offsets``: a stream with a fresh
    checkpoint then goes on after what a table has. Producers need not key their messages:
    see ``sources.arrival`` for the order.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select(
            "partition",
            "offset",
            F.col("timestamp").alias("time"),
            F.col("value").cast("string").alias("value"),
        )
    )
