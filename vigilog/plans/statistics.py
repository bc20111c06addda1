"""Counts, distributions and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilog.operators import parsing, stats
from vigilog.plans.registry import query
from vigilog.plans.tables import located_events, se_cte, sec_events, wire_records

SE = se_cte()
LONG_FORM = """
SELECT 'event_type' AS dimension, event_type AS key, count(*) AS n FROM se GROUP BY event_type
UNION ALL SELECT 'severity', severity, count(*) FROM se GROUP BY severity
UNION ALL SELECT 'country', coalesce(country, 'Unknown'), count(*) FROM se WHERE has_geo = 1 GROUP BY 2
UNION ALL SELECT 'total', 'total', count(*) FROM se
"""


@query(SE + "SELECT event_type, count(*) AS n FROM se GROUP BY event_type ORDER BY n DESC")
def count_by_event_type(spark, sf_dir):
    return stats.count_by(sec_events(spark, sf_dir), "event_type", "event_type").orderBy(F.desc("n"), "event_type")


@query(SE + "SELECT severity, count(*) AS n FROM se GROUP BY severity")
def count_by_severity(spark, sf_dir):
    return stats.count_by(sec_events(spark, sf_dir), "severity", "severity")


@query(SE + "SELECT coalesce(country, 'Unknown') AS country, count(*) AS n FROM se WHERE has_geo = 1 GROUP BY 1")
def count_by_country(spark, sf_dir):
    return stats.count_by_country(located_events(spark, sf_dir))


@query(SE + "SELECT user_type, count(*) AS n FROM se GROUP BY user_type")
def count_by_user_type(spark, sf_dir):
    return stats.count_by(sec_events(spark, sf_dir), "user_type", "user_type")


@query(SE + """SELECT count(*) AS events, count(DISTINCT event_type) AS event_types,
  count(DISTINCT CASE WHEN has_geo = 1 THEN coalesce(country, 'Unknown') END) AS countries FROM se""")
def event_totals(spark, sf_dir):
    return stats.event_totals(located_events(spark, sf_dir))


@query(SE + "SELECT event_id, ts, event_type, severity, user_id FROM se ORDER BY arrival_seq DESC LIMIT 1")
def latest_event(spark, sf_dir):
    return stats.latest_event(sec_events(spark, sf_dir)).select("event_id", "ts", "event_type", "severity", "user_id")


@query(SE + """SELECT CAST(sum(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high,
  CAST(sum(CASE WHEN severity = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT) AS critical FROM se""")
def high_severity_metrics(spark, sf_dir):
    return stats.high_severity_metrics(sec_events(spark, sf_dir))


@query(SE + "SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n FROM se GROUP BY 1, 2")
def events_per_minute(spark, sf_dir):
    return stats.events_per_minute(sec_events(spark, sf_dir))


def _timeline_sql(horizon: str) -> str:
    return SE + f"""SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n FROM se
    WHERE ts > (SELECT max(ts) FROM se) - INTERVAL {horizon} AND (SELECT count(*) FROM se) > 5 GROUP BY 1, 2"""


@query(_timeline_sql("30 MINUTES"))
def activity_timeline(spark, sf_dir):
    return stats.activity_timeline(sec_events(spark, sf_dir))


@query(_timeline_sql("1 DAY"))
def activity_timeline_day(spark, sf_dir):
    return stats.activity_timeline(sec_events(spark, sf_dir), horizon="1 day")


@query(SE + LONG_FORM)
def stats_grouping_sets(spark, sf_dir):
    return stats.distributions(located_events(spark, sf_dir))


@query(SE + LONG_FORM)
def stats_merge(spark, sf_dir):
    """Statistics of the log up to a day and of the rest, added up."""
    e = located_events(spark, sf_dir)
    day = F.lit("2024-01-16").cast("timestamp_ntz")
    return stats.merge(stats.distributions(e.filter(F.col("ts") < day)),
                       stats.distributions(e.filter(F.col("ts") >= day)))


@query(SE + LONG_FORM)
def stats_snapshot(spark, sf_dir):
    """Statistics to their JSON document and back."""
    document = stats.stats_document(stats.distributions(located_events(spark, sf_dir)))
    return stats.read_stats_document(document)


@query(SE + "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN severity = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS {s.lower()}"
    for s in ["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL"]) + " FROM se")
def severity_pivot(spark, sf_dir):
    return stats.severity_pivot(sec_events(spark, sf_dir))


@query(SE + """SELECT severity, count(*) AS n,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM se), 6) AS share FROM se GROUP BY severity""")
def severity_share(spark, sf_dir):
    return stats.severity_share(sec_events(spark, sf_dir))


@query(SE + """SELECT events, round(s, 3) AS seconds, round(events / s, 6) AS per_second
  FROM (SELECT count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM se) t""")
def throughput(spark, sf_dir):
    return stats.throughput(sec_events(spark, sf_dir))


@query(SE + """SELECT sent, delivered, sent - delivered AS failed, round(100.0 * delivered / sent, 2) AS success_pct
  FROM (SELECT count(*) AS sent, CAST(sum(CASE WHEN event_id % 19 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS delivered
        FROM se) t""")
def success_rate(spark, sf_dir):
    """Delivered means readable on arrival."""
    parsed = parsing.parse_value(wire_records(spark, sf_dir))
    return stats.success_rate(parsed, parsing.readable())


@query(SE + """SELECT coalesce(country, 'Unknown') AS country, count(*) AS n FROM se WHERE has_geo = 1
  GROUP BY 1 ORDER BY n DESC, country LIMIT 10""")
def top_countries(spark, sf_dir):
    return stats.top_countries(located_events(spark, sf_dir))


@query(SE + """SELECT event_type, count(*) AS n, min(arrival_seq) AS first_seq FROM se
  GROUP BY event_type ORDER BY n DESC, first_seq LIMIT 3""")
def top_event_types(spark, sf_dir):
    return stats.top_event_types(sec_events(spark, sf_dir))


@query(SE + """SELECT CAST(CAST(minute AS DATE) AS VARCHAR) AS day, max(n) AS peak_per_minute,
  CASE WHEN max(n) <= 30 THEN 'Slow Mode' WHEN max(n) <= 100 THEN 'Normal Rate' ELSE 'High Rate' END AS mode
  FROM (SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM se GROUP BY 1) t GROUP BY 1""")
def rate_mode(spark, sf_dir):
    return stats.rate_per_day(sec_events(spark, sf_dir))


@query(SE + " UNION ALL ".join(f"""SELECT '{c}' AS dimension, count(DISTINCT {c}) AS n, true AS close FROM se"""
                               for c in stats.SKETCHED))
def stats_distinct(spark, sf_dir):
    """Exact distinct counts, and whether merged sketches of three overlapping parts of the log come within 2 % of them."""
    e = sec_events(spark, sf_dir)
    parts = [stats.distinct_sketches(e.filter(F.col("event_id") % 5 < k + 3).filter(F.col("event_id") % 5 >= k)) for k in range(3)]
    found = stats.distinct_estimates(stats.merge_sketches(*parts)).withColumnRenamed("n", "estimate")
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in stats.SKETCHED])
    rows = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("n")) for c in stats.SKETCHED])
    return exact.select(F.explode(rows).alias("r")).select("r.*").join(found, "dimension").select(
        "dimension", "n", (F.abs(F.col("estimate") - F.col("n")) <= 0.02 * F.col("n")).alias("close"))
