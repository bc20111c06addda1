"""Statistics. Raw rows are combined map-side; only distinct keys are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog import schema as S
from vigilog.functions import codes, numbers, times

TOTAL = "total"


def country_key() -> Column:
    """Country of an event with a location, ``Unknown`` if that has none; null without a location."""
    return F.when(F.col("geo_location").isNotNull(), F.coalesce("geo_location.country", F.lit("Unknown")))


def count_by(events: DataFrame, key: Column | str, name: str) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return events.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def count_by_country(events: DataFrame) -> DataFrame:
    return count_by(events.filter(F.col("geo_location").isNotNull()), country_key(), "country")


def distributions(events: DataFrame) -> DataFrame:
    """All distributions in long form ``(dimension, key, n)``, plus the total.

    The raw rows are counted once per combination of the three keys. The
    grouping sets then expand that small table, not the events.
    """
    base = (events.select("event_type", "severity", country_key().alias("country"))
            .groupBy("event_type", "severity", "country").agg(F.count(F.lit(1)).alias("c")))
    sets = base.groupingSets([["event_type"], ["severity"], ["country"], []], "event_type", "severity", "country").agg(
        F.sum("c").alias("n"), F.grouping_id().alias("g"))
    return (sets.filter((F.col("g") != 6) | F.col("country").isNotNull())
            .select(F.when(F.col("g") == 3, "event_type").when(F.col("g") == 5, "severity")
                    .when(F.col("g") == 6, "country").otherwise(TOTAL).alias("dimension"),
                    F.when(F.col("g") == 3, F.col("event_type")).when(F.col("g") == 5, F.col("severity"))
                    .when(F.col("g") == 6, F.col("country")).otherwise(F.lit(TOTAL)).alias("key"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


NULL_KEY = "null"


def merge(*parts: DataFrame) -> DataFrame:
    """Add up statistics of disjoint sets of events; the old table may be one of them."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("dimension", "key").agg(F.sum("n").cast("bigint").alias("n"))


def empty_stats(spark) -> DataFrame:
    return spark.createDataFrame([], S.STATS)


def stats_document(stats: DataFrame, last_update: Column | None = None) -> DataFrame:
    """Statistics as one JSON document with a map per dimension.

    The maps hold one entry per distinct key, so they are as small as the
    statistics table itself. A null key, which a map can't hold, is the text
    ``null`` in the document and null again when it is read.
    """
    named = F.coalesce("key", F.lit(NULL_KEY))
    stats = stats.groupBy("dimension", named.alias("key")).agg(F.sum("n").cast("bigint").alias("n"))

    def counts(dimension):
        entry = F.when(F.col("dimension") == dimension, F.struct("key", "n"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry)))
    doc = stats.agg(
        counts("event_type").alias("event_counts"),
        counts("severity").alias("severity_counts"),
        counts("country").alias("country_counts"),
        F.coalesce(F.sum(F.when(F.col("dimension") == TOTAL, F.col("n"))), F.lit(0)).alias("messages_received"))
    stamp = last_update if last_update is not None else F.current_timestamp()
    return doc.select(F.to_json(F.struct("*", times.iso_z(stamp).alias("last_update"))).alias("value"))


def read_stats_document(df: DataFrame) -> DataFrame:
    """The long form of a statistics document; maps that are missing count as empty."""
    counts = T.MapType(T.StringType(), T.LongType())
    doc = T.StructType([T.StructField(f"{d}_counts", counts) for d in ("event", "severity", "country")]
                       + [T.StructField("messages_received", T.LongType())])
    d = df.select(F.from_json("value", doc).alias("d")).select("d.*")
    nothing = F.create_map().cast(counts)

    def entries(dimension, col):
        return F.transform(F.map_entries(F.coalesce(col, nothing)),
                           lambda e: F.struct(F.lit(dimension).alias("dimension"), e["key"].alias("key"),
                                              e["value"].alias("n")))
    total = F.array(F.struct(F.lit(TOTAL).alias("dimension"), F.lit(TOTAL).alias("key"),
                             F.coalesce("messages_received", F.lit(0)).alias("n")))
    rows = F.concat(entries("event_type", F.col("event_counts")), entries("severity", F.col("severity_counts")),
                    entries("country", F.col("country_counts")), total)
    key = F.when(F.col("r.key") != NULL_KEY, F.col("r.key"))
    return d.select(F.explode(rows).alias("r")).select("r.dimension", key.alias("key"), "r.n")


SKETCHED = ("event_type", "user_id", "session_id", "ip_address")


def distinct_sketches(events: DataFrame, columns: tuple[str, ...] = SKETCHED, bits: int = 14) -> DataFrame:
    """A sketch of the distinct values per column: ``dimension``, ``sketch``; one row each, whatever the number of values.

    Sketches of disjoint or overlapping sets of events merge to that of their
    union, so they can be kept beside the counts and joined per batch. 14 bits
    give a standard error of 0.8 %.
    """
    row = events.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("sketch")) for c in columns])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """Sketches of the union of the parts' events."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("dimension").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """About how many distinct values each column has; nulls are not values."""
    return sketches.select("dimension", F.hll_sketch_estimate("sketch").alias("n"))


def event_totals(events: DataFrame) -> DataFrame:
    """Events, distinct types and distinct countries; the distinct counts run over the counted combinations."""
    base = (events.select("event_type", country_key().alias("country"))
            .groupBy("event_type", "country").agg(F.count(F.lit(1)).alias("c")))
    return base.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("events"),
                    F.count_distinct("event_type").alias("event_types"),
                    F.count_distinct("country").alias("countries"))


def latest_event(events: DataFrame) -> DataFrame:
    """The event that arrived last."""
    return events.orderBy(F.desc("arrival_seq")).limit(1)


def high_severity_metrics(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if(F.col("severity") == "HIGH").alias("high"),
                      F.count_if(F.col("severity") == "CRITICAL").alias("critical"))


def events_per_minute(events: DataFrame, ts: str = "ts") -> DataFrame:
    return (events.groupBy(times.minute(F.col(ts)).alias("minute"), "event_type")
            .agg(F.count(F.lit(1)).alias("n")))


def activity_timeline(events: DataFrame, horizon: str = "30 minutes", as_of: Column | None = None,
                      more_than: int = 5) -> DataFrame:
    """Counts per minute and type over the horizon before ``as_of`` (default: the newest event).

    Empty unless there are more than ``more_than`` events with a time.
    """
    timed = events.filter(F.col("ts").isNotNull())
    if as_of is None:
        as_of = timed.agg(F.max("ts")).scalar()
    enough = timed.limit(more_than + 1).agg(F.count(F.lit(1))).scalar() > more_than
    recent = timed.filter(enough & (F.col("ts") > as_of - F.expr(f"INTERVAL {horizon}")))
    return events_per_minute(recent)


def throughput(events: DataFrame) -> DataFrame:
    """Events per second over the span of the data, 0 for an empty span."""
    spans = events.agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    seconds = F.coalesce(times.seconds_between(F.col("lo"), F.col("hi")), F.lit(0.0))
    return spans.select("events", F.round(seconds, 3).alias("seconds"),
                        F.round(numbers.ratio(F.col("events"), seconds), 6).alias("per_second"))


def success_rate(outcomes: DataFrame, ok: Column) -> DataFrame:
    """Sent, delivered and failed records with the share delivered in percent."""
    return (outcomes.agg(F.count(F.lit(1)).alias("sent"), F.count_if(ok).alias("delivered"))
            .select("sent", "delivered", (F.col("sent") - F.col("delivered")).alias("failed"),
                    F.round(numbers.percent(F.col("delivered"), F.col("sent")), 2).alias("success_pct")))


def severity_pivot(events: DataFrame) -> DataFrame:
    """One row with a column per severity in fixed order, zero where there is none."""
    return events.agg(*[F.count_if(F.col("severity") == s).alias(s.lower()) for s in S.SEVERITIES])


def severity_share(events: DataFrame) -> DataFrame:
    """Count and share of the total per severity; the total is taken over the counted rows, one per severity."""
    total = F.sum("n").over(W.partitionBy(F.lit(1)))
    return count_by(events, "severity", "severity").select(
        "severity", "n", F.round(F.col("n").cast("double") / total, 6).alias("share"))


def top_countries(events: DataFrame, k: int = 10) -> DataFrame:
    return count_by_country(events).orderBy(F.desc("n"), "country").limit(k)


def top_event_types(events: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent types; of equally frequent ones the first seen leads."""
    return (events.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.min("arrival_seq").alias("first_seq"))
            .orderBy(F.desc("n"), "first_seq").limit(k))


def rate_per_day(events: DataFrame) -> DataFrame:
    """Busiest minute of every day with the name of its rate mode."""
    per_minute = events.groupBy(times.minute(F.col("ts")).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    return (per_minute.groupBy(F.col("minute").cast("date").cast("string").alias("day")).agg(F.max("n").alias("peak_per_minute"))
            .withColumn("mode", codes.rate_mode(F.col("peak_per_minute"))))


def tag_counts(tags: DataFrame) -> DataFrame:
    return tags.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
