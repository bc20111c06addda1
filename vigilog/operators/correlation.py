"""Events that share a correlation id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.ordered import previous
from vigilog.operators.skew import HOT_ROWS


def _correlated(events: DataFrame) -> DataFrame:
    return events.filter(F.coalesce("correlation_id", F.lit("")) != "")


def chains(events: DataFrame) -> DataFrame:
    """Size, span and distinct types per chain.

    Counted per (chain, type) first: a huge chain is combined map-side and the
    list is taken over its distinct types only.
    """
    per_type = (_correlated(events).groupBy("correlation_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")))
    return per_type.groupBy("correlation_id").agg(
        F.sum("n").cast("bigint").alias("events"), F.min("lo").alias("first_ts"), F.max("hi").alias("last_ts"),
        F.array_sort(F.collect_list("event_type")).alias("event_types"))


def linked_pairs(events: DataFrame, bucket_rows: int = 1_000_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each event of a chain with the one before it.

    Linear in the events: a chain of n events gives n - 1 links. A chain of
    more than ``hot_rows`` is cut by arrival number, so no task holds more
    than ``bucket_rows`` of it.
    """
    linked = previous(_correlated(events), ["correlation_id"], ["arrival_seq"],
                      {"event_id": "prev_event_id", "event_type": "prev_event_type", "ts": "prev_ts"},
                      F.floor(F.col("arrival_seq") / F.lit(bucket_rows)), hot_rows)
    return linked.filter(F.col("prev_event_id").isNotNull())
