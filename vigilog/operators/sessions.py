"""Sessions by id and by gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilog.functions import times
from vigilog.operators.enrich import lookup_hot
from vigilog.operators.ordered import bucketed, running_sum
from vigilog.operators.skew import HOT_ROWS
from vigilog.session import durable

MAX_SESSION = "8 hours"


def session_parts(events: DataFrame) -> DataFrame:
    """Opening, closing, first and last time and size per session id.

    Parts of one session can be merged, so a session of any size is combined
    map-side and the order of arrival does not matter.
    """
    login, logout = F.col("event_type") == "LOGIN_SUCCESS", F.col("event_type") == "LOGOUT"
    return events.filter(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min(F.when(login, F.col("ts"))).alias("created_at"),
        F.max(F.when(logout, F.col("ts"))).alias("ended_at"),
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("events"))


def merge_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("session_id").agg(
        F.min("created_at").alias("created_at"), F.max("ended_at").alias("ended_at"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("events").alias("events"))


def session_summary(events: DataFrame, max_age: str = MAX_SESSION) -> DataFrame:
    """Lifecycle per session id: opened by a login, closed by a logout, expired after ``max_age``."""
    return session_parts(events).withColumns({
        "expires_at": F.col("created_at") + F.expr(f"INTERVAL {max_age}"),
        "seconds": F.round(times.seconds_between(F.col("first_seen"), F.col("last_seen")), 3)})


def ends_at(max_age: str = MAX_SESSION) -> Column:
    """When a session is over: with its last event after a logout, else by age.

    One that was not seen to open ages from its first event.
    """
    by_age = F.coalesce("created_at", "first_seen") + F.expr(f"INTERVAL {max_age}")
    return F.when(F.col("ended_at") >= F.col("created_at"), F.col("last_seen")).otherwise(by_age)


def session_state(sessions: DataFrame, as_of) -> DataFrame:
    """``closed``, ``expired``, ``active``, or ``unopened`` when no login was seen."""
    return sessions.withColumn(
        "state", F.when(F.col("created_at").isNull(), "unopened")
        .when(F.col("ended_at") >= F.col("created_at"), "closed")
        .when(F.col("expires_at") < as_of, "expired").otherwise("active"))


def session_lookup(events: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Every event with the session that was live when it happened, if any.

    A session is live until it expires or, if that is earlier, its last logout.
    """
    if sessions is None:
        sessions = session_summary(events)
    table = sessions.select("session_id", F.col("created_at").alias("_from"), F.least(
        "expires_at", F.when(F.col("ended_at") >= F.col("created_at"), F.col("ended_at"))).alias("_until"))
    live = F.coalesce(F.col("ts").between(F.col("_from"), F.col("_until")), F.lit(False))
    return (lookup_hot(events, table, "session_id")
            .withColumns({"live": live, "session_start": F.when(live, F.col("_from"))}).drop("_from", "_until"))


def lifecycle(events: DataFrame, max_age: str = MAX_SESSION) -> DataFrame:
    """One row per session id with its fixed end; events behind the end don't belong to it.

    It begins with its first event and is open from its first login, if that
    comes within ``max_age`` of the beginning. It ends with the first logout
    from then on, else ``max_age`` after the login, or the beginning without
    one. Every step is an aggregation combined map-side and a lookup that keeps
    hot ids apart.
    """
    age = F.expr(f"INTERVAL {max_age}")
    login, logout = F.col("event_type") == "LOGIN_SUCCESS", F.col("event_type") == "LOGOUT"
    rows = events.filter(F.col("session_id").isNotNull()).select("session_id", "event_type", "ts")
    begun = rows.groupBy("session_id").agg(F.min("ts").alias("_first"), F.min(F.when(login, F.col("ts"))).alias("_login"))
    begun = begun.withColumn("created_at", F.when(F.col("_login") <= F.col("_first") + age, F.col("_login")))
    begun = begun.select("session_id", "created_at", (F.coalesce("created_at", "_first") + age).alias("_limit"))
    outs = lookup_hot(rows.filter(logout), begun, "session_id").filter(F.col("ts").between(F.col("created_at"), F.col("_limit")))
    ended = outs.groupBy("session_id").agg(F.min("ts").alias("ended_at"))
    spans = durable(begun.join(ended, "session_id", "left"), "sessions").select(
        "session_id", "created_at", "ended_at", F.coalesce("ended_at", "_limit").alias("ends_at"))
    own = lookup_hot(rows, spans, "session_id").filter(F.col("ts") <= F.col("ends_at"))
    state = F.when(F.col("created_at").isNull(), "unopened").when(F.col("ended_at").isNull(), "expired").otherwise("closed")
    return (own.groupBy("session_id", "created_at", "ended_at", "ends_at")
            .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("events"))
            .withColumn("state", state))


def gap_sessions(events: DataFrame, gap_seconds: int, key: str = "user_id", bucket_seconds: int = 3600,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sessions per key: a pause longer than the gap starts a new one.

    The sessions of a hot key are built per time bucket first and then joined
    across buckets, so its events are spread over tasks and the second step
    sees sessions only. Those are at most span / gap + buckets per key.
    """
    rows, _ = bucketed(events, [key], times.time_bucket(F.col("ts"), bucket_seconds), hot_rows)

    def cut(df, keys, order, start, last_end):
        w = W.partitionBy(*keys).orderBy(*order)
        prior = F.lag(last_end).over(w)
        new = F.when(prior.isNull() | (times.seconds_between(prior, F.col(start)) > gap_seconds), 1).otherwise(0)
        return df.withColumn("_new", new).withColumn(
            "_s", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))

    local = (cut(rows, [key, "_bucket"], ["ts"], "ts", "ts").groupBy(key, "_bucket", "_s").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"), F.count(F.lit(1)).alias("events")))
    whole = (cut(local, [key], ["started_at"], "started_at", "ended_at").groupBy(key, "_s").agg(
        F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
        F.sum("events").cast("bigint").alias("events")))
    return whole.select(key, F.col("_s").cast("bigint").alias("session_no"), "started_at", "ended_at", "events")


def shared_sessions(events: DataFrame) -> DataFrame:
    """Sessions in which more than one user appears."""
    return (events.filter(F.col("session_id").isNotNull()).groupBy("session_id")
            .agg(F.count_distinct("user_id").alias("users")).filter(F.col("users") > 1))


def login_attempts(events: DataFrame, bucket_seconds: int = 3600, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Failed logins with their running number per user, in time order."""
    failures = events.filter(F.col("event_type") == "LOGIN_FAILURE")
    return running_sum(failures, ["user_id"], ["ts", "arrival_seq"], F.lit(1),
                       times.time_bucket(F.col("ts"), bucket_seconds), "attempt_number", hot_rows)
