"""Keyed Kafka sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from vigilog.operators.parsing import kafka_record


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options: acknowledged by all replicas, five retries half a second apart."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "includeHeaders": "true",
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.retry.backoff.ms": "500",
    }


def write_topic(events: DataFrame, servers: str, topic: str) -> None:
    kafka_record(events).write.format("kafka").options(**sink_options(servers, topic)).save()


def write_topic_stream(events: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (kafka_record(events).writeStream.format("kafka").options(**sink_options(servers, topic))
            .option("checkpointLocation", checkpoint).start())
