"""Kafka topic as a stream or as a bounded table.

The connector is a separate Spark package; only ``load()`` needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators import parsing


def source_options(servers: str, topic: str, from_beginning: bool = True, max_per_trigger: int | None = None,
                   min_per_trigger: int | None = None, max_delay: str = "2s",
                   fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options. Offsets live in the checkpoint of the query, in place of a consumer group.

    ``min_per_trigger`` with ``max_delay`` holds a batch back until it has that
    many records or the delay is over, whichever is first. Offsets that the topic
    no longer holds end the query, unless ``fail_on_data_loss`` is off.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_beginning else "latest",
        "includeHeaders": "true",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_per_trigger is not None:
        options["minOffsetsPerTrigger"] = str(min_per_trigger)
        options["maxTriggerDelay"] = max_delay
    return options


def read_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **kw)).load()


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything the topic holds now, as a table."""
    options = source_options(servers, topic)
    options["endingOffsets"] = "latest"
    return spark.read.format("kafka").options(**options).load()


def arrival_seq(records: DataFrame) -> DataFrame:
    """Unique, sortable key per record: time received by the topic, then partition and offset."""
    return records.withColumn("arrival_seq", F.struct(
        F.col("timestamp").alias("received"), F.col("partition"), F.col("offset")))


def severe_records(records: DataFrame) -> DataFrame:
    """HIGH and CRITICAL records by their header, before any value is parsed.

    A record without the header is kept, so the result must be filtered by
    field once more after parsing.
    """
    severity = parsing.enum_header(F.col("headers"), "severity")
    return records.filter(severity.isNull() | severity.isin("HIGH", "CRITICAL"))


def events(records: DataFrame) -> DataFrame:
    """Parsed columns of topic records; unreadable ones keep ``_corrupt``."""
    kept = arrival_seq(records).select("arrival_seq", F.col("timestamp").alias("received_at"), "value")
    return parsing.parse_value(kept)
