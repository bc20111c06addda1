"""Running values over ordered groups of any size.

A plain window puts a whole group into one task. Here the groups that are too
large for that are cut into buckets that follow their order. What a bucket
needs to know about the ones before it (a sum, a last row) is aggregated
map-side, carried over by a window on the small per-bucket table, and handed
in as one extra row per bucket. All rows are shuffled once, on (group,
bucket), and no join is needed. Other groups are one bucket each.

The input is read more than once, for its group sizes with the keys only. If
it is expensive to compute, pass ``durable`` output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilog.operators.skew import HOT_ROWS, hot_keys, with_hot
from vigilog.session import durable

_BUCKET, _REAL = "_bucket", "_real"


def bucketed(df: DataFrame, keys: list[str], bucket: Column, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(all rows, rows of hot groups), both with ``_bucket``, which is null for other groups."""
    hot = hot_keys(df, keys, hot_rows)
    every = with_hot(df, keys, hot).withColumn(_BUCKET, F.when(F.col("_hot"), bucket)).drop("_hot")
    return every, with_hot(df, keys, hot, "inner").withColumn(_BUCKET, bucket).drop("_hot")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, bucket: Column,
                name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inclusive running sum of ``value`` per group in ``order``.

    ``bucket`` must not decrease along ``order``; ``order`` must be unique
    within a group. The buckets of one group should be small enough for a
    task, and a group should have few enough of them for the same.
    """
    rows, hot = bucketed(df.withColumn("_value", value.cast("bigint")), keys, bucket, hot_rows)
    sums = hot.groupBy(*keys, _BUCKET).agg(F.sum("_value").alias("_value"))
    before = W.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(*keys, _BUCKET, F.coalesce(F.sum("_value").over(before), F.lit(0)).alias("_value"),
                          F.lit(0).alias(_REAL))
    both = rows.withColumn(_REAL, F.lit(1)).unionByName(carried, allowMissingColumns=True)
    run = (W.partitionBy(*keys, _BUCKET).orderBy(_REAL, *order)
           .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (both.withColumn(name, F.sum("_value").over(run))
            .filter(F.col(_REAL) == 1).drop(_BUCKET, "_value", _REAL))


def previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], bucket: Column,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """Values of the row before in the same group; ``columns`` maps a column to its new name."""
    rows, hot = bucketed(df, keys, bucket, hot_rows)
    needed = list(dict.fromkeys([*order, *columns]))
    lasts = hot.groupBy(*keys, _BUCKET).agg(F.max_by(F.struct(*needed), F.struct(*order)).alias("_last"))
    follows = W.partitionBy(*keys).orderBy(_BUCKET)
    carried = (lasts.withColumn("_next", F.lead(_BUCKET).over(follows)).filter(F.col("_next").isNotNull())
               .select(*keys, F.col("_next").alias(_BUCKET), *[F.col("_last")[c].alias(c) for c in needed],
                       F.lit(0).alias(_REAL)))
    both = rows.withColumn(_REAL, F.lit(1)).unionByName(carried, allowMissingColumns=True)
    run = W.partitionBy(*keys, _BUCKET).orderBy(_REAL, *order)
    return (both.withColumns({new: F.lag(old).over(run) for old, new in columns.items()})
            .filter(F.col(_REAL) == 1).drop(_BUCKET, _REAL))


def with_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """1-based place of every row in a total order of the whole table.

    The rows are range-sorted, which spreads equal leading keys as long as the
    order is unique, and written once, since the sampled range bounds of a
    second run could differ. A row's place is its index within its partition
    plus the sizes of the partitions before it.
    """
    numbered = durable(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "position")
    part, index = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per sort partition, so the window and the broadcast are bounded
    # by spark.sql.shuffle.partitions.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + index + 1).drop("_part", "_offset", "_id"))
