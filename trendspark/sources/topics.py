"""Topic scans (S1-S3, S5) and parsing with quarantine.

A topic is any streaming or batch DataFrame with a ``value`` column
(binary or text) and optionally ``topic``. Kafka is used when the
connector is on the classpath; otherwise the same ``value`` column comes
from a text/JSON file stream, which is also what the tests drive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.records import from_json_text


def kafka_stream(spark: SparkSession, servers: str, topics, starting: str = "latest",
                 options: dict | None = None) -> DataFrame:
    """Subscribe to one or several topics (``value``, ``topic``, ...).

    ``starting`` only applies when the checkpoint has no offsets yet; after
    that the checkpoint (T5) is the durable position, as group offsets are
    for a plain consumer.
    """
    topics = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics)
              .option("startingOffsets", starting))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def text_stream(spark: SparkSession, path: str, topic: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File stand-in of S1: one JSON record per line in ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    return df.withColumn("topic", F.lit(topic)) if topic else df


def topics_stream(spark: SparkSession, root: str, topics, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stand-in of S2: one stream over the ``topic=<name>`` folders of several topics (``value``, ``topic``)."""
    reader = spark.readStream.format("text").schema("value string, topic string").option("basePath", root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    names = ",".join(topics)
    return reader.load(f"{root.rstrip('/')}/topic={{{names}}}")


def json_file_stream(spark: SparkSession, path: str, schema: StructType,
                     max_files_per_trigger: int | None = None,
                     options: dict | None = None) -> DataFrame:
    """Incremental JSON-lines scan; only files not yet in the checkpoint."""
    reader = spark.readStream.schema(schema).option("encoding", "UTF-8")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.json(path)


def parse_topic(df: DataFrame, schema: StructType, key: str | None = None,
                value_col: str = "value", keep=()) -> tuple[DataFrame, DataFrame]:
    """Parse records; return ``(good, quarantine)``.

    ``good`` holds flattened records whose ``key`` parsed to a non-null
    value; ``quarantine`` keeps the raw text of the others (malformed JSON,
    or a record without its key), so one bad message neither becomes a
    null group nor costs the batch its write. Without ``key`` nothing is
    quarantined.
    """
    # inline(array(...)) flattens the parsed struct through a Generate node:
    # the key filter below stays above it instead of being pushed down and
    # re-running the JSON parse once per predicate
    parsed = df.select(*keep, F.col(value_col).cast("string").alias("_raw"),
                       F.inline(F.array(from_json_text(value_col, schema))))
    fields = [f.name for f in schema.fields]
    if key is None:
        return parsed.select(*keep, *fields), parsed.limit(0).select(*keep, "_raw")
    ok = F.col(key).isNotNull()
    good = parsed.where(ok).select(*keep, *fields)
    bad = parsed.where(~ok).select(*keep, F.col("_raw").alias("raw_value"))
    return good, bad
