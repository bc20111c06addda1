"""Lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.skew import HOT_ROWS, hot_keys


def enrich_users(events: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """User profile columns for every event; unknown users get nulls.

    No broadcast is forced: a profile table below the broadcast threshold is
    broadcast by Catalyst or, from its run-time size, by AQE. Above it both
    sides are shuffled and AQE splits the partition of a hot user. Profiles
    must be unique per user.
    """
    return events.join(users, key, "left")


def lookup_hot(facts: DataFrame, lookup: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join to a lookup that is unique per key and derived by a query.

    AQE does not split skew below an aggregation, so hot keys are taken out
    beforehand: their few lookup rows are broadcast. Rows of all other keys
    are joined by shuffle; rows without a key match nothing and are not
    shuffled.
    """
    keyed = facts.filter(F.col(key).isNotNull())
    hot = hot_keys(keyed, [key], hot_rows)
    hot_lookup = lookup.join(F.broadcast(hot), key, "left_semi")
    hot_rows_ = keyed.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_lookup), key, "left")
    cold_rows = keyed.join(F.broadcast(hot), key, "left_anti").join(lookup, key, "left")
    return (cold_rows.unionByName(hot_rows_)
            .unionByName(facts.filter(F.col(key).isNull()), allowMissingColumns=True))
