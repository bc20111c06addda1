"""Finding the keys that are too frequent for one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000
HOT_SHARE = 0.0001


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``rows`` rows and more than ``share`` of all rows.

    Rows are counted map-side. At most ``1 / share`` keys can pass, whatever
    the size of the data, so the result is safe to broadcast. The total is
    summed over the counted keys, whose shuffle is reused for it.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    return sizes.filter((F.col("_n") > rows) & (F.col("_n") > total * F.lit(share))).select(*keys)


def with_hot(df: DataFrame, keys: list[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """Join the hot keys, null included, as the flag ``_hot``; ``how='inner'`` keeps their rows only."""
    names = {k: f"_hot_{k}" for k in keys}
    flags = hot.withColumnsRenamed(names).withColumn("_flag", F.lit(True))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return (df.join(F.broadcast(flags), same, how)
            .withColumn("_hot", F.coalesce("_flag", F.lit(False))).drop("_flag", *names.values()))
