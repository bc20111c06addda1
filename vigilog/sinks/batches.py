"""Per-batch writers for ``foreachBatch``. Each may run twice for a batch with the same result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.functions import codes
from vigilog.operators import parsing, sessions, stats
from vigilog.operators.dedup import append_new, keep_first
from vigilog.operators.sampling import continue_sample
from vigilog.operators.views import retain_last
from vigilog.sinks import snapshots
from vigilog.sinks.seen_index import BUCKETS, FAN, SeenIndex

OnBatch = Callable[[DataFrame, int], None]


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch, replaced when the batch is retried."""
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def console(rows: int = 20) -> OnBatch:
    """Print number, time, size and the first rows of every batch that has any."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            n = df.count()
            if n:
                now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
                print(f"batch {batch_id} | {now} | {n} records")
                df.show(rows, truncate=False)
        finally:
            df.unpersist()
    return on_batch


def routed(main: str, severe: str) -> OnBatch:
    """All events to the main table by log level, severe ones with their lines to a second table."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        leveled = df.withColumn("log_level", codes.log_level(F.col("severity")))
        leveled.write.mode("overwrite").partitionBy("log_level").parquet(batch_path(main, batch_id))
        write_batch(parsing.severe_lines(df), severe, batch_id)
    return on_batch


def good_and_dead(good: str, dead: str) -> OnBatch:
    """Readable records to one table, the others with their text to a dead-letter table."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        write_batch(parsing.good_records(df), good, batch_id)
        write_batch(parsing.dead_letters(df), dead, batch_id)
    return on_batch


def checked(dead: str, invalid: str, then: OnBatch) -> OnBatch:
    """Split ``ingest.checked_records``: unreadable ones to ``dead``, a report of broken rules to ``invalid``.

    ``then`` gets all readable events, those with broken rules too.
    """
    def on_batch(df: DataFrame, batch_id: int) -> None:
        keys = [c for c in ("arrival_seq", "received_at") if c in df.columns]
        write_batch(parsing.dead_letters(df).select(*keys, "raw", "reason"), dead, batch_id)
        good = parsing.good_records(df)
        write_batch(good.filter(F.size("violations") > 0).select(*keys, "event_id", "raw", "violations"), invalid, batch_id)
        then(good.drop("violations"), batch_id)
    return on_batch


def unseen(out: str, index: str, key: str = "event_id", buckets: int = BUCKETS, then: OnBatch | None = None) -> OnBatch:
    """First arrival per key over all batches: what the index of seen keys does not hold yet.

    There is no horizon, and only the buckets that may hold a key of the batch
    are read. The keys of a batch join the index after its rows were written;
    a batch that is retried asks the versions before it, so it writes the same.
    """
    def on_batch(df: DataFrame, batch_id: int) -> None:
        seen = SeenIndex(df.sparkSession, index, buckets)
        write_batch(seen.drop_seen(keep_first(df, key), key, before=batch_id), out, batch_id)
        fresh = df.sparkSession.read.schema(df.schema).parquet(batch_path(out, batch_id))
        seen.add(fresh, key, batch_id)
        if batch_id % FAN == 0:
            seen.compact(batch_id)
        if then is not None:
            then(fresh, batch_id)
    return on_batch


def retained(path: str, n: int = 1000, fmt: str = "parquet") -> OnBatch:
    """Keep the last n events in a versioned table (or JSON snapshot) of at most n rows."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        old = snapshots.latest_version(spark, path, before=batch_id)
        if old is None:
            log = keep_first(df)
        else:
            log = append_new(spark.read.schema(df.schema).format(fmt).load(old), df)
        snapshots.write_version(retain_last(log, n), path, batch_id, files=1, fmt=fmt)
    return on_batch


def stats_documents(path: str) -> OnBatch:
    """Running statistics as one JSON document per version."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        old = snapshots.latest_version(spark, path, before=batch_id)
        counts = stats.distributions(df)
        if old is not None:
            counts = stats.merge(stats.read_stats_document(spark.read.text(old)), counts)
        snapshots.write_version(stats.stats_document(counts), path, batch_id, files=1, fmt="text")
    return on_batch


def running_stats(path: str) -> OnBatch:
    """Add the counts of a batch to the statistics of the version before it."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        old = snapshots.latest_version(spark, path, before=batch_id)
        counts = stats.distributions(df)
        if old is not None:
            counts = stats.merge(spark.read.schema(counts.schema).parquet(old), counts)
        snapshots.write_version(counts, path, batch_id, files=1)
    return on_batch


def changed_rows(path: str) -> OnBatch:
    """Log of the rows an update-mode aggregation changed, per batch."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id)
    return on_batch


def latest_rows(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last logged state per key of a ``changed_rows`` table."""
    values = [c for c in log.columns if c not in set(keys) | {"batch_id"}]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
            .select(*keys, *[F.col("v")[c].alias(c) for c in values]))


def sampled(out: str, state: str, keys: list[str], budget: int = 30, sampling: bool = True,
            then: OnBatch | None = None, forget_after: int | None = None) -> OnBatch:
    """Rate limit or priority sampling that goes on across batches.

    The state, places used and events accepted per window, is a small
    versioned table. Only the first 3 x budget events of a window in a batch
    can be accepted, and those are cut out before the shuffle; the other
    events are counted map-side. ``then`` gets the accepted events.

    A window without an event in the last ``forget_after`` batches is closed and
    leaves the state. The last of ``keys`` numbers the windows, others name
    groups of them: per group the highest closed number is kept (in ``state`` with
    ``_closed`` added to its name), and an event of a window up to it that is
    not open any more is refused, so no window can spend its budget twice.
    """
    group, number = keys[:-1], keys[-1]
    shut = f"{state.rstrip('/')}_closed"

    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        zero = F.lit(0).cast("bigint")
        touched = F.lit(batch_id).cast("bigint")
        shape = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen")).withColumns({"accepted": zero, "touched": touched})
        path = snapshots.latest_version(spark, state, before=batch_id)
        old = spark.read.schema(shape.schema).parquet(path) if path else spark.createDataFrame([], shape.schema)
        if forget_after is not None:
            path = snapshots.latest_version(spark, shut, before=batch_id)
            closed = spark.read.schema(df.select(*keys).schema).parquet(path) if path else df.select(*keys).limit(0)
            df = _still_open(df, old, closed, keys)
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen")).withColumns({"accepted": zero, "touched": touched})
        write_batch(continue_sample(df, old.drop("touched"), keys, budget, sampling), out, batch_id)
        accepted = spark.read.parquet(batch_path(out, batch_id))
        added = accepted.groupBy(*keys).agg(zero.alias("seen"), F.count(F.lit(1)).alias("accepted"), F.max(touched).alias("touched"))
        states = old.unionByName(counted).unionByName(added).groupBy(*keys).agg(
            F.sum("seen").alias("seen"), F.sum("accepted").alias("accepted"),
            F.coalesce(F.max("touched"), touched).alias("touched"))
        if forget_after is not None:
            over = F.col("touched") <= batch_id - forget_after
            highest = states.filter(over).select(*keys).unionByName(closed).groupBy(*group).agg(F.max(number).alias(number))
            snapshots.write_version(highest.filter(F.col(number).isNotNull()).select(*keys), shut, batch_id)
            states = states.filter(~over)
        snapshots.write_version(states, state, batch_id)
        if then is not None:
            then(accepted.drop("place", "accepted"), batch_id)
    return on_batch


def _still_open(df: DataFrame, open_: DataFrame, closed: DataFrame, keys: list[str]) -> DataFrame:
    """Events of windows that are open, or behind all closed ones of their group."""
    group, number = keys[:-1], keys[-1]
    live = open_.select(*keys, F.lit(True).alias("_live"))
    marked = df.join(live, keys, "left")
    if group:
        marked = marked.join(closed.select(*group, F.col(number).alias("_closed")), group, "left")
    else:
        marked = marked.withColumn("_closed", closed.agg(F.max(number)).scalar())
    fresh = F.coalesce(F.col(number) > F.col("_closed"), F.lit(True)) | F.coalesce("_live", F.lit(False))
    return marked.filter(fresh).drop("_live", "_closed")


def session_log(out: str, state: str, max_age: str = sessions.MAX_SESSION, lateness: str = "10 minutes",
                remember: str = "1 day") -> OnBatch:
    """One row per session when it is over, in event time.

    The state is a versioned table of the sessions still open, so it is sized
    by what is live within ``max_age``, not by history, and of those that ended
    within ``remember`` before the clock: what comes later of these is left out
    and can't make a second row. The events of a batch are combined per session
    map-side before they meet it. A row without session id keeps the clock: the
    newest event time so far.
    """
    def newest(rows: DataFrame, column: str) -> int:
        return rows.agg(F.max(F.unix_micros(column))).first()[0] or 0

    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        parts, now = sessions.session_parts(df), newest(df, "ts")
        path = snapshots.latest_version(spark, state, before=batch_id)
        told = None
        if path:
            old = spark.read.parquet(path)
            now = max(now, newest(old.filter(F.col("session_id").isNull()), "last_seen"))
            told = old.filter("over").withColumn("told", F.lit(True))
            parts = parts.join(told.select("session_id"), "session_id", "left_anti")
            parts = old.filter(~F.col("over")).drop("over", "told").unionByName(parts)
        clock = spark.range(1).select(F.timestamp_micros(F.lit(now)).alias("last_seen"))
        merged = sessions.merge_parts(parts.unionByName(clock, allowMissingColumns=True))
        passed = F.timestamp_micros(F.lit(now)) - F.expr(f"INTERVAL {lateness}")
        over = F.col("session_id").isNotNull() & F.coalesce(sessions.ends_at(max_age) < passed, F.lit(False))
        states = merged.withColumns({"over": over, "told": F.lit(False)})
        if told is not None:
            states = states.unionByName(told.filter(sessions.ends_at(max_age) >= passed - F.expr(f"INTERVAL {remember}")))
        snapshots.write_version(states, state, batch_id)
        ended = spark.read.parquet(snapshots.version_path(state, batch_id)).filter("over AND NOT told").drop("over", "told")
        write_batch(sessions.session_state(ended.withColumn("expires_at", sessions.ends_at(max_age)), passed)
                    .drop("expires_at"), out, batch_id)
    return on_batch


def persisted(*steps: OnBatch) -> OnBatch:
    """One or more writers over a batch that is computed once, stateful operators before it included.

    A batch without rows, as the watermark alone can cause, is skipped.
    """
    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():
                for step in steps:
                    step(df, batch_id)
        finally:
            df.unpersist()
    return on_batch
