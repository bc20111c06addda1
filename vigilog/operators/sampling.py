"""Rate limit and priority sampling per time window.

Rule, for the events of a window in arrival order with budget B: stop once B
are accepted; a HIGH or CRITICAL event is accepted; any other is accepted
unless more than B/2 are accepted already and its place is not a multiple of 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilog.functions import codes


MAP_SIDE_ROWS = 10_000  # spark.sql.optimizer.windowGroupLimitThreshold of our sessions
SALTS = 64


def _head(events: DataFrame, keys: list[str], rows: int, order: str) -> DataFrame:
    """The first rows per window, numbered.

    Spark cuts before the shuffle as well as after it, up to MAP_SIDE_ROWS.
    Beyond, a window is first cut in SALTS groups of its own, each by another
    task: the first rows of the window are among the first rows of its groups,
    so the task that numbers them meets SALTS x ``rows`` rows at most.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(order))
    if rows > MAP_SIDE_ROWS:
        salt = F.pmod(F.xxhash64(order), F.lit(SALTS))
        group = F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(order))
        events = events.withColumn("_salt", salt).withColumn("_rank", group).filter(F.col("_rank") <= rows).drop("_salt", "_rank")
    return events.withColumn("place", place).filter(F.col("place") <= rows).withColumn(
        "place", F.col("place").cast("bigint"))


def _free(budget: int) -> Column:
    """Whether the rule lets an event at this place pass while the budget lasts."""
    return F.coalesce((F.col("place") <= budget // 2 + 1) | codes.is_high(F.col("severity"))
                      | (F.col("place") % 3 == 0), F.lit(False))


def rate_limit(events: DataFrame, keys: list[str], budget: int = 30, order: str = "arrival_seq") -> DataFrame:
    """The first ``budget`` events per window; the rest is dropped, not delayed."""
    return _head(events, keys, budget, order)


def priority_sample(events: DataFrame, keys: list[str], budget: int = 30, order: str = "arrival_seq") -> DataFrame:
    """Accepted events with their ``place`` in the window and the running ``accepted`` count.

    Every third event is a candidate at least, so the budget is spent by place
    3B at the latest. Cutting there first is exact and lets Spark cut before
    the shuffle: a window with a third of all events costs what any other does.
    """
    return _accept(_head(events, keys, 3 * budget, order), keys, budget, _free(budget), F.lit(0), order)


def continue_sample(events: DataFrame, state: DataFrame, keys: list[str], budget: int = 30, sampling: bool = True,
                    order: str = "arrival_seq") -> DataFrame:
    """The same for later events of windows that were begun; ``state`` has ``seen`` and ``accepted`` per window."""
    begun = state.select(*keys, F.col("seen").alias("_seen"), F.col("accepted").alias("_accepted"))
    head = (_head(events, keys, 3 * budget, order).join(begun, keys, "left")
            .withColumn("place", F.col("place") + F.coalesce("_seen", F.lit(0))))
    free = _free(budget) if sampling else F.lit(True)
    return _accept(head, keys, budget, free, F.coalesce("_accepted", F.lit(0)), order).drop("_seen", "_accepted")


def _accept(head: DataFrame, keys: list[str], budget: int, free: Column, before: Column, order: str) -> DataFrame:
    run = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (head.withColumn("_free", free)
            .withColumn("accepted", before + F.sum(F.when(F.col("_free"), 1).otherwise(0)).over(run))
            .filter(F.col("_free") & (F.col("accepted") <= budget)).drop("_free"))
