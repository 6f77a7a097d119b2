"""Topic writer. Needs the Kafka connector on the class path."""

from candlemill.schemas import TOPIC


def write_topic(payloads, servers, checkpoint, topic=TOPIC):
    """Starts the stream that publishes ``(key, value)`` payloads."""
    return (
        payloads.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
