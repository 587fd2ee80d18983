"""Publish rows as JSON records to a topic.

``value`` is ``to_json(struct(*))`` of the selected columns; Kafka receives
it as the message value (no key, as published by the pollers). Without the
Kafka connector the same records go to a text sink, one JSON per line,
which the file-stream sources read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.records import to_json_value


def publish(df: DataFrame, topic: str, servers: str | None = None, path: str | None = None,
            cols=None) -> None:
    """Batch publish: to Kafka when ``servers`` is given, else to ``path`` as text."""
    out = to_json_value(df, cols)
    if servers:
        (out.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).save())
    else:
        out.write.mode("append").text(f"{path.rstrip('/')}/topic={topic}")


def publish_stream(df: DataFrame, topic: str, checkpoint: str, servers: str | None = None,
                   path: str | None = None, cols=None, trigger: dict | None = None) -> StreamingQuery:
    """Streaming publish with a checkpoint (exactly-once into files)."""
    out = to_json_value(df, cols)
    if servers:
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", topic))
    else:
        w = out.writeStream.format("text").option("path", f"{path.rstrip('/')}/topic={topic}")
    w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
