"""Assembly of streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vigilog.functions import times
from vigilog.operators import parsing, quality
from vigilog.operators.stats import TOTAL, country_key
from vigilog.sinks import batches


def run_stream(df: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", interval: str | None = None) -> StreamingQuery:
    """Start ``on_batch`` over every micro-batch.

    The checkpoint is not optional: a restart goes on where the query stopped.
    Replaying from the start takes a fresh folder. Without ``interval`` the
    query handles what is there and ends; with one it keeps running.
    """
    writer = df.writeStream.foreachBatch(on_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def checked_records(records: DataFrame) -> DataFrame:
    """Every record as an event with defaults and time, unreadable ones included.

    ``_corrupt`` has the text of an unreadable record, ``violations`` the rules a
    readable one broke before defaults were filled. Where the records have
    ``arrival_seq``, an unreadable one takes its id from that, so that equal
    texts that arrive apart stay apart. An event without time takes that of its
    arrival: of the record, if it has one as ``received_at``, else of the
    micro-batch, which a retry keeps. ``arrived_at`` is the time of arrival itself.
    """
    parsed = quality.with_violations(parsing.parse_value(records))
    if "arrival_seq" in records.columns:
        own = F.concat(F.lit("unreadable "), F.to_json(F.struct("arrival_seq")))
        parsed = parsed.withColumn("event_id", F.when(parsing.readable(), F.col("event_id")).otherwise(own))
    arrived = F.col("received_at") if "received_at" in records.columns else F.current_timestamp()
    return (parsing.with_time(parsing.fill_defaults(parsed)).withColumn("arrived_at", arrived)
            .withColumn("ts", F.coalesce("ts", "arrived_at")))


def accepted_events(records: DataFrame) -> DataFrame:
    """Readable records to events with defaults and time; only unreadable ones are left out."""
    return parsing.good_records(checked_records(records)).drop("violations")


def dedup(events: DataFrame, horizon: str = "1 day", salts: int = 1, clock: str = "ts") -> DataFrame:
    """First arrival per event id; ids are remembered until the watermark passes them.

    With ``salts`` above 1 the copies of an id are first reduced in that many
    separate groups, so that one id repeated endlessly does not load one task.
    Rows behind the watermark are dropped: where the time in ``ts`` is not to be
    trusted, ``clock`` names a time of arrival.
    """
    marked = events.withWatermark(clock, horizon)
    if salts > 1:
        salt = F.pmod(F.xxhash64("arrival_seq"), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark(["event_id", "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(["event_id"])


def consume(records: DataFrame, out: str, checkpoint: str, window_seconds: int = 60, budget: int = 30,
            keep: int = 1000, horizon: str = "1 day", interval: str | None = None,
            forget_after: int | None = None) -> StreamingQuery:
    """Records to accepted events, retained events and statistics, in this order:

    parse, drop repeats, sample per time window, then retain and count what was
    accepted. ``records`` has ``value`` and ``arrival_seq``, unique per record.
    Unreadable records go to ``dead``; readable ones that break the contract are
    reported in ``invalid`` and go on like any other. Windows of the sampler
    that got nothing for ``forget_after`` batches leave its state, and a later
    event of one starts it anew; without that number they stay.
    """
    events = dedup(checked_records(records), horizon, clock="arrived_at").drop("arrived_at")
    windowed = events.withColumn("window_no", times.time_bucket(F.col("ts"), window_seconds))
    after = batches.persisted(batches.retained(f"{out}/retained", keep), batches.running_stats(f"{out}/stats"))
    sample = batches.sampled(f"{out}/accepted", f"{out}/windows", ["window_no"], budget, then=after,
                             forget_after=forget_after)
    step = batches.checked(f"{out}/dead", f"{out}/invalid", then=sample)
    return run_stream(windowed, batches.persisted(step), checkpoint, interval=interval)


def minute_counts(events: DataFrame, lateness: str = "30 minutes") -> DataFrame:
    """Events per minute and type; a minute is dropped from state once it is too old."""
    return (events.withWatermark("ts", lateness)
            .groupBy(F.window("ts", "1 minute").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("minute"), "event_type", "n"))


def running_totals(events: DataFrame) -> DataFrame:
    """Totals per dimension and key in update mode; late events count like any other.

    The state holds one row per distinct key.
    """
    def row(dimension, key):
        return F.struct(F.lit(dimension).alias("dimension"), key.alias("key"))
    rows = F.array(row("event_type", F.col("event_type")), row("severity", F.col("severity")),
                   row("country", country_key()), row(TOTAL, F.lit(TOTAL)))
    rows = F.filter(rows, lambda r: r["key"].isNotNull())
    return (events.select(F.explode(rows).alias("r")).select("r.*")
            .groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n")))


def gap_session_counts(events: DataFrame, gap: str = "6 hours", lateness: str = "1 day") -> DataFrame:
    """Sessions per user that end after a pause."""
    return (events.withWatermark("ts", lateness)
            .groupBy("user_id", F.session_window("ts", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("ended_at"))
            .select("user_id", F.col("w.start").alias("started_at"), "ended_at", "events"))
