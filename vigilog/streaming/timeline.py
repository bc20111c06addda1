"""The rolling activity timeline of a stream.

The state is a ring of counts per second and type over the horizon, a small
versioned table: at most horizon x types rows, however many events arrive. A
batch is combined to such counts map-side before it meets the ring. The clock
is the newest event time so far; seconds that fall out of the horizon leave the
ring, and rows that are older than it never enter. Only the timeline drops them:
the total below counts every event.

Read as of any whole second from the clock on, the ring gives exactly what
``operators.stats.activity_timeline`` gives over all events: a second holds the
events after its predecessor up to itself, so a horizon of whole seconds never
cuts one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions import times
from vigilog.sinks import snapshots
from vigilog.sinks.batches import OnBatch

HORIZON = "30 minutes"
_RING = "second timestamp, minute timestamp, event_type string, n long, total long"


def _seconds(events: DataFrame) -> DataFrame:
    """Counts per second (rounded up), minute and type."""
    second = F.timestamp_seconds(F.ceil(F.unix_micros("ts") / F.lit(1_000_000)))
    return events.filter(F.col("ts").isNotNull()).groupBy(
        second.alias("second"), times.minute(F.col("ts")).alias("minute"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def rolling(path: str, horizon: str = HORIZON) -> OnBatch:
    """Keep the ring of the last ``horizon`` before the newest event."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        ring = _seconds(df)
        # The total is a row without second; null types are rows with one.
        parts = ring.withColumn("total", F.lit(0).cast("bigint")).unionByName(
            ring.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).select("total"), allowMissingColumns=True)
        old = snapshots.latest_version(spark, path, before=batch_id)
        if old is not None:
            parts = parts.unionByName(spark.read.schema(_RING).parquet(old))
        merged = parts.groupBy("second", "minute", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        clock = merged.agg(F.max("second")).scalar()
        kept = merged.filter(F.col("second").isNull() | (F.col("second") > clock - F.expr(f"INTERVAL {horizon}")))
        snapshots.write_version(kept, path, batch_id, files=1)
    return on_batch


def timeline(spark: SparkSession, path: str, as_of: Column | None = None, horizon: str = HORIZON, more_than: int = 5) -> DataFrame:
    """Counts per minute and type over the horizon before ``as_of`` (default: the clock, the newest event's second).

    ``as_of`` must be a whole second, not before the clock. Empty unless more
    than ``more_than`` events with a time have come, late ones included.
    """
    latest = snapshots.latest_version(spark, path)
    if latest is None:
        return spark.createDataFrame([], "minute timestamp, event_type string, n long")
    ring = spark.read.schema(_RING).parquet(latest)
    total = ring.agg(F.sum("total")).scalar()
    now = ring.agg(F.max("second")).scalar() if as_of is None else as_of
    recent = ring.filter((total > more_than) & (F.col("second") > now - F.expr(f"INTERVAL {horizon}")))
    return recent.groupBy("minute", "event_type").agg(F.sum("n").alias("n"))
