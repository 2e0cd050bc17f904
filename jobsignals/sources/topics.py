"""Message topics, read as a stream or as a bounded replay.

The format is a parameter: ``kafka`` needs its connector on the class path; a
file format (``text``, ``parquet``) with a ``value`` column stands in elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# --- Fixed values: topic of the posting messages
TOPIC = "recruitment_information"
# --- End of fixed values

_VALUE = StructType([StructField("value", StringType())])


def kafka_options(servers: str, topic: str = TOPIC, starting: str | None = None) -> dict[str, str]:
    """Options to read a topic; ``starting`` None leaves the connector's own default."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting is not None:
        options["startingOffsets"] = starting
    return options


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_stream(spark: SparkSession, options: Mapping[str, str], format: str = "kafka",
                schema: StructType | None = None, path: str | None = None) -> DataFrame:
    """Unbounded stream of messages with a ``value`` column."""
    reader = spark.readStream.format(format).options(**options)
    if format != "kafka":
        reader = reader.schema(schema or _VALUE)
    return reader.load(path) if path else reader.load()


def replay(spark: SparkSession, options: Mapping[str, str], format: str = "kafka",
           path: str | None = None) -> DataFrame:
    """All messages of the topic as a batch table, from the earliest to the latest."""
    reader = spark.read.format(format).options(**options)
    if format == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("endingOffsets", "latest")
    else:
        reader = reader.schema(_VALUE)
    return reader.load(path) if path else reader.load()


def publish(messages: DataFrame, options: Mapping[str, str], format: str = "kafka",
            path: str | None = None) -> None:
    """Send each row's ``value`` as one message."""
    if format == "text":
        messages = messages.selectExpr("CAST(value AS STRING) AS value")
    writer = messages.write.format(format).options(**options).mode("append")
    writer.save(path) if path else writer.save()
