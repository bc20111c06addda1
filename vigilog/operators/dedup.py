"""Removing repeated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(events: DataFrame, key: str = "event_id", order: str = "arrival_seq") -> DataFrame:
    """First arrival per key; rows without a key are all kept.

    The rank filter is applied before the shuffle too, so however often a key
    repeats, each map task sends one row of it.
    """
    own = F.when(F.col(key).isNull(), F.col(order))
    rank = F.row_number().over(W.partitionBy(key, own).orderBy(order))
    return events.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def drop_seen(events: DataFrame, history: DataFrame, key: str = "event_id") -> DataFrame:
    """Events whose key is not in the history; only the keys of the history travel.

    An event without a key is never seen. Nothing stands between the join and
    its shuffles, so a key that repeats endlessly can be split.
    """
    return events.join(history.select(key), key, "left_anti")


def append_new(history: DataFrame, events: DataFrame, key: str = "event_id",
               order: str = "arrival_seq") -> DataFrame:
    """History plus the new events it does not hold yet, each once; the history is not shuffled."""
    return history.unionByName(drop_seen(keep_first(events, key, order), history, key), allowMissingColumns=True)
