"""Any page of a sorted view, however deep, without sorting again.

The view is range-sorted once and kept as one file per range; a row has its
place within its range. The index is a small table with a row per range: number
of rows, rows before it, first and last sort key. A page is found by counting
in the index and read from the one or two ranges it lies in; a key is found by
the first keys. Nothing is sorted, and nothing larger than the index is touched,
to reach a page.

The driver sees the index rows of the ranges that hold the page, not the index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilog.functions import numbers
from vigilog.operators import views
from vigilog.sinks import snapshots

_PART, _PLACE, _KEY = "_part", "_place", "_key"


@dataclass(frozen=True)
class RankIndex:
    """A kept sorted view: ``rows`` by range and ``index`` below one version folder."""

    spark: SparkSession
    root: str
    field: str
    ascending: bool

    @property
    def ranges(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/index")

    @property
    def rows(self) -> DataFrame:
        shape = self.spark.read.parquet(f"{self.root}/shape").schema
        return self.spark.read.schema(shape).parquet(f"{self.root}/rows")

    def between(self, first: int, last: int) -> DataFrame:
        """Rows at the places ``first`` to ``last`` (from 1), with their place as ``pos``."""
        hit = (F.col("_before") < last) & (F.col("_before") + F.col("_rows") >= first)
        found = self.ranges.filter(hit).select(_PART, "_before").collect()
        before = {r[_PART]: r["_before"] for r in found}
        rows = self.rows.filter(F.col(_PART).isin(list(before)))
        if len(before) == 1:
            offset: Column = F.lit(next(iter(before.values())))
        else:
            offset = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col(_PART)) \
                if before else F.lit(0)
        if before:  # bounds on the place itself let the reader skip row groups of the file
            rows = rows.filter(F.col(_PLACE).between(first - max(before.values()), last - min(before.values())))
        return (rows.withColumn("pos", (F.col(_PLACE) + offset).cast("bigint"))
                .filter(F.col("pos").between(first, last)).drop(_PART, _PLACE, _KEY))

    def page(self, number: int, size: int = views.PAGE_SIZE) -> DataFrame:
        """Page ``number`` (from 1); empty behind the last page."""
        return self.between((number - 1) * size + 1, number * size)

    def page_info(self, number: int, size: int = views.PAGE_SIZE) -> DataFrame:
        """Total, pages, first and last row number of a page, from the index alone."""
        total = F.col("total")
        return self.ranges.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("total")).select(
            "total", numbers.page_count(total, size).alias("pages"),
            F.least(total, F.lit((number - 1) * size + 1)).alias("first_row"),
            F.least(total, F.lit(number * size)).alias("last_row"))

    def place_of(self, key) -> int:
        """Place of the first row that does not come before ``key``; total + 1 if all do.

        ``key`` is a value of the sort expression and must not be null. The
        index names the only range in which that row can be.
        """
        def reached(column: str) -> Column:
            return F.col(column) >= F.lit(key) if self.ascending else F.col(column) <= F.lit(key)
        # Null keys of a descending view come last: they are behind every key.
        behind = F.col("_last").isNull() if not self.ascending else F.lit(False)
        found = self.ranges.filter(reached("_last") | behind).orderBy(_PART).limit(1).collect()
        if not found:
            return self.ranges.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0] + 1
        hit = reached(_KEY) | (F.col(_KEY).isNull() if not self.ascending else F.lit(False))
        place = self.rows.filter((F.col(_PART) == found[0][_PART]) & hit).agg(F.min(_PLACE)).first()[0]
        return found[0]["_before"] + place

    def page_of(self, key, size: int = views.PAGE_SIZE) -> int:
        return (self.place_of(key) - 1) // size + 1


def build(events: DataFrame, path: str, field: str = "Time", ascending: bool = False, version: int = 0,
          ranges: int | None = None) -> RankIndex:
    """Sort once and keep the view with its index as ``version`` below ``path``.

    A range is a file, so its number should make files of a normal size;
    without it Spark's shuffle partitions decide. The sort ends in the arrival
    number, so equal keys are spread over ranges like any other. A second build
    of the same version replaces it; readers of another version don't notice.
    """
    spark = events.sparkSession
    root = snapshots.version_path(path, version)
    order = views.ordering(field, ascending)
    keyed = events.withColumn(_KEY, views.sort_key(field))
    dealt = keyed.repartitionByRange(ranges, *order) if ranges else keyed.repartitionByRange(*order)
    numbered = dealt.withColumn(_PART, F.spark_partition_id()).sortWithinPartitions(_PART, *order)
    # The row number within a task; ids count from the number of the task in the upper bits.
    numbered = numbered.withColumn(_PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    numbered.limit(0).write.mode("overwrite").parquet(f"{root}/shape")  # the columns, also of a view without rows
    numbered.write.mode("overwrite").partitionBy(_PART).parquet(f"{root}/rows")
    kept = spark.read.schema(numbered.schema).parquet(f"{root}/rows")
    sizes = kept.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"), F.min_by(_KEY, _PLACE).alias("_first"),
                                    F.max_by(_KEY, _PLACE).alias("_last"))
    # One row per range; the window is over those.
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    index = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)).cast("bigint"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{root}/index")
    return RankIndex(spark, root, field, ascending)


def load(spark: SparkSession, path: str, field: str = "Time", ascending: bool = False, version: int = 0) -> RankIndex:
    """A view built before, with the field and direction it was built for."""
    return RankIndex(spark, snapshots.version_path(path, version), field, ascending)
