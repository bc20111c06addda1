"""Shards of limited size by extendible hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.session import durable

LIMIT = 32 * 1024 * 1024
STEP = 12          # bits looked at in one round
KEY_BITS = 60      # bits of the hash of the id; then those of the row's number follow
ROW_BITS = 60


def key_bits(doc_id: Column) -> Column:
    """60 hash bits of the id; a null id hashes as empty."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _bits(step: int) -> Column:
    """The next STEP bits of a row's address in round ``step``."""
    per = KEY_BITS // STEP
    word = F.col("h") if step < per else F.col("h2")
    return F.shiftright(word, KEY_BITS - STEP * (step % per + 1)).bitwiseAND((1 << STEP) - 1)


def _text(value: Column, width: int) -> Column:
    return F.substring(F.lpad(F.bin(value), STEP, "0"), 1, width)


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The shards: ``shard`` (its hash prefix as bits, the first is the root's ""), ``depth``, ``shard_bytes``, ``shard_rows``.

    ``rows`` has ``h``, ``h2`` and ``n_bytes``. A bucket over the limit, and only
    such a one, splits on the next bit. A round adds up bytes by the next twelve
    bits of the open buckets, combined before the shuffle, and then halves the
    prefix eleven times over those sums alone; buckets still too large at its end
    go on into the next round. Ids that share all their bits go on with bits of
    the row's number. Only a bucket of a single row may stay over the limit.
    """
    spark = rows.sparkSession
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    if total["b"] <= limit or total["n"] <= 1:
        return spark.createDataFrame([("", 0, total["b"], total["n"])][:total["n"]],
                                     "shard string, depth int, shard_bytes long, shard_rows long")
    leaves, open_rows, step = [], rows.withColumn("at", F.lit("")), 0
    while True:
        cells = durable(open_rows.groupBy("at", _bits(step).alias("cell"))
                        .agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "cells")
        levels = [cells.select("at", "cell", "b", "n")]
        for _ in range(STEP - 1):
            levels.insert(0, levels[0].groupBy("at", F.shiftright("cell", 1).alias("cell"))
                          .agg(F.sum("b").alias("b"), F.sum("n").alias("n")))
        rounds = reduce(DataFrame.union, [
            level.select(F.concat("at", F.substring(F.lpad(F.bin("cell"), k, "0"), 1, k)).alias("shard"),
                         F.lit(step * STEP + k).alias("depth"), "b", "n") for k, level in enumerate(levels, 1)])
        rounds = durable(rounds, "levels")
        # A bucket exists where its parent was split: over the limit with more than one row.
        split = rounds.where((F.col("b") > limit) & (F.col("n") > 1))
        parents = split.select(F.col("shard").alias("parent")).union(open_rows_roots(open_rows, step, spark))
        there = rounds.withColumn("parent", F.expr("substring(shard, 1, length(shard) - 1)")).join(parents, "parent", "left_semi")
        last = (step + 1) * STEP
        leaves.append(there.where((F.col("b") <= limit) | (F.col("n") <= 1)).select("shard", "depth", "b", "n"))
        over = durable(there.where((F.col("b") > limit) & (F.col("n") > 1) & (F.col("depth") == last)).select("shard"), "over")
        step += 1
        if over.isEmpty():
            break
        if step * STEP >= KEY_BITS + ROW_BITS:
            raise ValueError("rows with one number can't be told apart")
        deeper = open_rows.withColumn("at", F.concat("at", _text(_bits(step - 1), STEP)))
        open_rows = durable(deeper.join(over, deeper["at"] == over["shard"], "left_semi"), "open")
    return reduce(DataFrame.union, leaves).select(
        "shard", "depth", F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows"))


def open_rows_roots(open_rows: DataFrame, step: int, spark) -> DataFrame:
    """Prefixes with which a round begins."""
    if step == 0:
        return spark.createDataFrame([("",)], "parent string")
    return open_rows.select(F.col("at").alias("parent")).distinct()


def address(depth: int) -> Column:
    """The first ``depth`` bits of a row's address as text; whole rounds at a time."""
    return F.concat(F.lit(""), *[_text(_bits(s), STEP) for s in range(-(-depth // STEP))])


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The shard of each document: ``doc_id``, ``n_bytes``, ``shard``, ``depth``, ``shard_bytes``, ``shard_rows``.

    Bytes are those of the text in UTF-8; null and empty texts have 0. Repeated
    rows are rows of their own: where an id's rows exceed the limit together,
    they part by row number. A row larger than the limit has a shard of its own.
    An empty table has no shard. Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row")) \
        .withColumn("h", key_bits(F.col("doc_id"))) \
        .withColumn("h2", F.conv(F.substring(F.md5(F.col("row").cast("string")), 1, 15), 16, 10).cast("long"))
    rows = durable(rows, "rows")
    shards = durable(directory(rows, limit), "shards")
    depth = shards.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    depths = [r[0] for r in shards.select("depth").distinct().collect()]  # one number per level
    placed = rows.withColumn("address", address(depth))
    # The one prefix of the address that is a shard: a join per level, each row meets one of them.
    joined = reduce(DataFrame.union, [
        placed.withColumn("shard", F.expr(f"substring(address, 1, {d})")).join(
            shards.where(F.col("depth") == d), "shard") for d in sorted(depths)] or [
        placed.join(shards, F.lit(False)).drop("address")])
    return joined.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")
