"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Target of each source: ``source``, ``source_size``, ``target``, ``rate``.

    ``sizes`` has one row per source (``source``, ``source_size``). Sources in
    order, null last, take the weights in turn. Targets are shares of all sizes
    by weight, at most ``most`` times the source; what is cut off is shared
    again by weight among the others until none is above. That is: in order of
    size over weight, sources are full as long as their limit is below the share
    the rest would give them. A source of size 0 has target and rate 0.

    The window without partitions runs over sources, one row each, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.select("source", F.col("source_size").cast("long").alias("source_size"), choice.cast("long").alias("weight"))
    fill = Window.orderBy((F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighed.select(
        "source", "source_size", "weight",
        (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest_weight"))
    # The first source whose limit is not below its share ends the filling: all from it on share the rest.
    exact = lambda name: F.col(name).cast("decimal(19,0)")
    below = exact("source_size") * most * exact("rest_weight") <= exact("rest") * exact("weight")
    shared = filled.withColumn(
        "last", F.max_by(F.struct("rest", "rest_weight"), F.when(~below, F.col("rest_weight"))).over(everything))
    full = F.col("last").isNull() | (F.col("rest_weight") > F.col("last.rest_weight"))
    share = F.col("last.rest").cast("double") * F.col("weight").cast("double") / F.col("last.rest_weight").cast("double")
    target = F.when(full, (F.col("source_size") * most).cast("double")).otherwise(share)
    return shared.select("source", "source_size", target.alias("target"),
                         F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most))))
                         .otherwise(0.0).alias("rate"))


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone; a null id has one too."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """Copies of each document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken``.

    Sizes are words of whole texts; null and empty texts have 0. A document is
    taken floor(rate) times and once more when its coin falls below the rest of
    the rate. Coins depend on doc_id alone: reruns agree, and repeated rows fall
    alike. A null source is a source. Other columns are not read.

    One aggregate per source, combined before the shuffle, and one join to it;
    Spark broadcasts the sources when they are few and splits a large one when not.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        words(F.col("text").cast("string")).alias("size"))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    joined = sized.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    copies = F.floor("rate") + F.when(coin(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.select("doc_id", "d.source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies")) \
        .withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The documents themselves, each as often as the plan takes it, with their own columns."""
    sized = docs.select(F.struct("*").alias("own"), F.col("source").cast("string").alias("source"),
                        F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text").cast("string")).alias("size"))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    joined = sized.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    copies = F.floor("rate") + F.when(coin(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.where(copies > 0) \
        .select("own", F.explode(F.sequence(F.lit(1), copies.cast("int")))).select("own.*")
