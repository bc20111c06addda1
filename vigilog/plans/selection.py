"""Filters, duplicates, sampling, sorting and pages."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilog.operators import dedup, rank_index, sampling, views
from vigilog.operators.sessions import login_attempts
from vigilog.plans.records import COUNTRY_CITY
from vigilog.plans.registry import query
from vigilog.plans.tables import located_events, se_cte, sec_events
from vigilog.session import scratch_dir
from vigilog.sinks.seen_index import SeenIndex

SE = se_cte()
RANK = "CASE severity WHEN 'CRITICAL' THEN 5 WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 2 ELSE 1 END"
HIGH = "severity IN ('HIGH', 'CRITICAL')"
CUT = "2024-01-08 00:00:00"
COPIED = se_cte(also=f""", se2 AS (SELECT event_id, arrival_seq, event_type, severity FROM se
  UNION ALL SELECT event_id, arrival_seq + 1000000000000, event_type, 'FATAL' FROM se WHERE {HIGH})""")


def repeated(events):
    """The log with its severe events sent once more at the end, under another severity."""
    again = views.high_severity(events).withColumns({
        "arrival_seq": F.col("arrival_seq") + F.lit(1000000000000), "severity": F.lit("FATAL")})
    return events.unionByName(again)


def history(events):
    """The first part of the log."""
    return events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))


@query(SE + f"SELECT event_id, event_type, severity, user_id FROM se WHERE {HIGH}")
def high_severity_events(spark, sf_dir):
    return views.high_severity(sec_events(spark, sf_dir)).select("event_id", "event_type", "severity", "user_id")


@query(SE + "SELECT event_id, country, city FROM se WHERE has_geo = 1")
def geo_events(spark, sf_dir):
    return views.with_location(located_events(spark, sf_dir)).select(
        "event_id", F.col("geo_location.country").alias("country"), F.col("geo_location.city").alias("city"))


@query(COPIED + """SELECT event_id, arrival_seq, event_type, severity FROM
  (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS r FROM se2) t WHERE r = 1""")
def dedup_first(spark, sf_dir):
    return dedup.keep_first(repeated(sec_events(spark, sf_dir)).select(
        "event_id", "arrival_seq", "event_type", "severity"))


@query(COPIED + f"""SELECT event_id, arrival_seq, event_type, severity FROM se2
  WHERE event_id NOT IN (SELECT event_id FROM se WHERE ts < TIMESTAMP '{CUT}')""")
def anti_join_seen(spark, sf_dir):
    """Events not in the history, repeats among themselves left as they are."""
    e = sec_events(spark, sf_dir)
    return dedup.drop_seen(repeated(e).select("event_id", "arrival_seq", "event_type", "severity"), history(e))


@query(COPIED + f"""SELECT event_id, arrival_seq, event_type, severity FROM se2
  WHERE event_id NOT IN (SELECT event_id FROM se WHERE ts < TIMESTAMP '{CUT}')""")
def anti_join_indexed(spark, sf_dir):
    """The same by an index of the history, built in two batches: its buckets are read where a filter asks for it."""
    e = sec_events(spark, sf_dir)
    index = SeenIndex(spark, scratch_dir(spark, "seen"))
    for batch_id in range(2):
        index.add(history(e).filter(F.col("event_id") % 2 == batch_id), "event_id", batch_id)
    return index.drop_seen(repeated(e).select("event_id", "arrival_seq", "event_type", "severity"))


@query(COPIED + "SELECT event_id, arrival_seq, event_type, severity FROM se")
def append_dedup(spark, sf_dir):
    """The first part of the log as history, the whole log with repeats as new events."""
    e = sec_events(spark, sf_dir)
    columns = ["event_id", "arrival_seq", "event_type", "severity"]
    return dedup.append_new(history(e).select(*columns), repeated(e.select(*columns)))


@query(SE + "SELECT event_id, ts, event_type FROM se ORDER BY arrival_seq DESC LIMIT 1000")
def retain_last_n(spark, sf_dir):
    return views.retain_last(sec_events(spark, sf_dir)).select("event_id", "ts", "event_type")


def _day(events):
    return events.withColumn("day", F.to_date("ts").cast("string"))


LIMITED = """SELECT event_id, day, place FROM (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY arrival_seq) AS place FROM se) t WHERE place <= 30"""


@query(SE + LIMITED)
def rate_limit(spark, sf_dir):
    return sampling.rate_limit(_day(sec_events(spark, sf_dir)), ["day"]).select("event_id", "day", "place")


PRIORITY = f"""SELECT event_id, day, place, accepted FROM (
  SELECT *, CAST(sum(CASE WHEN candidate THEN 1 ELSE 0 END) OVER (PARTITION BY day ORDER BY place) AS BIGINT) AS accepted
  FROM (SELECT *, place <= 16 OR {HIGH} OR place % 3 = 0 AS candidate
        FROM (SELECT event_id, severity, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
                row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY arrival_seq) AS place FROM se) a) b) c
  WHERE candidate AND accepted <= 30"""


@query(SE + PRIORITY)
def priority_sample(spark, sf_dir):
    return sampling.priority_sample(_day(sec_events(spark, sf_dir)), ["day"]).select(
        "event_id", "day", "place", "accepted")


LARGE = 4000


@query(SE + f"""SELECT event_id, place, accepted FROM (
  SELECT *, CAST(sum(CASE WHEN candidate THEN 1 ELSE 0 END) OVER (ORDER BY place) AS BIGINT) AS accepted
  FROM (SELECT *, place <= {LARGE // 2 + 1} OR {HIGH} OR place % 3 = 0 AS candidate
        FROM (SELECT event_id, severity, row_number() OVER (ORDER BY arrival_seq) AS place FROM se) a) b) c
  WHERE candidate AND accepted <= {LARGE}""")
def priority_sample_large(spark, sf_dir):
    """The whole log as one window with a budget beyond what Spark cuts before the shuffle."""
    e = sec_events(spark, sf_dir).withColumn("window_no", F.lit(0))
    return sampling.priority_sample(e, ["window_no"], LARGE).select("event_id", "place", "accepted")


@query(SE + """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt_number
  FROM se WHERE event_type = 'LOGIN_FAILURE'""")
def login_attempt_number(spark, sf_dir):
    return login_attempts(sec_events(spark, sf_dir)).select("event_id", "user_id", "attempt_number")


def _placed(order: str, where: str = "true") -> str:
    return (SE + f"SELECT event_id, row_number() OVER (ORDER BY {order}) AS pos FROM se WHERE {where}")


@query(_placed("ts DESC, arrival_seq"))
def sort_events_time(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "ts")
    return views.sorted_positions(e, "Time").select("event_id", "pos")


@query(_placed(f"{RANK} DESC, arrival_seq"))
def sort_events_severity(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "severity")
    return views.sorted_positions(e, "Severity").select("event_id", "pos")


@query(_placed(f"{COUNTRY_CITY}, arrival_seq"))
def sort_events_location(spark, sf_dir):
    e = located_events(spark, sf_dir).select("event_id", "arrival_seq", "geo_location")
    return views.sorted_positions(e, "Location", ascending=True).select("event_id", "pos")


@query(_placed("ip_address, arrival_seq"))
def sort_events_source_ip(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "ip_address")
    return views.sorted_positions(e, "Source IP", ascending=True).select("event_id", "pos")


def _numbered(rows, field="Time", ascending=False, start=0):
    """Number the few rows of a top list or page."""
    w = W.orderBy(*views.ordering(field, ascending))
    return rows.withColumn("pos", (F.row_number().over(w) + start).cast("bigint"))


@query(_placed("ts DESC, arrival_seq") + " ORDER BY pos LIMIT 50")
def recent_events(spark, sf_dir):
    e = sec_events(spark, sf_dir)
    return _numbered(views.first_rows(e, views.PAGE_SIZE)).select("event_id", "pos")


@query(_placed("ts DESC, arrival_seq", HIGH) + " ORDER BY pos LIMIT 10")
def recent_high_severity(spark, sf_dir):
    e = views.high_severity(sec_events(spark, sf_dir))
    return _numbered(views.first_rows(e, views.HIGH_SEVERITY_ROWS)).select("event_id", "pos")


@query(_placed(f"{RANK} DESC, arrival_seq") + " ORDER BY pos LIMIT 50 OFFSET 100")
def page_events(spark, sf_dir):
    """Page 3 of the log by severity."""
    e = sec_events(spark, sf_dir)
    return _numbered(views.page(e, 3, field="Severity"), "Severity", start=100).select("event_id", "pos")


NUMBERED = f"""SELECT event_id, row_number() OVER (ORDER BY {RANK} DESC, arrival_seq) AS pos, {RANK} AS rank FROM se"""


@query(SE + f"""SELECT event_id, pos FROM ({NUMBERED}) t, (SELECT ceil(count(*) / 50.0)::BIGINT * 3 // 4 AS number FROM se) p
  WHERE pos > (number - 1) * 50 AND pos <= number * 50""")
def page_deep(spark, sf_dir):
    """A page three quarters down the log by severity, from a kept view."""
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "severity")
    view = rank_index.build(e, scratch_dir(spark, "view"), "Severity")
    pages = view.page_info(1).first()["pages"]
    return view.page(pages * 3 // 4).select("event_id", "pos")


@query(SE + f"""SELECT event_id, pos FROM ({NUMBERED}) t,
    (SELECT (min(pos) - 1) // 50 + 1 AS number FROM ({NUMBERED}) s WHERE rank <= 2) p
  WHERE pos > (number - 1) * 50 AND pos <= number * 50""")
def page_seek(spark, sf_dir):
    """The page on which the events of LOW severity begin."""
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "severity")
    view = rank_index.build(e, scratch_dir(spark, "view"), "Severity")
    return view.page(view.page_of(2)).select("event_id", "pos")


@query(SE + """SELECT count(*) AS total, CAST(ceil(count(*) / 50.0) AS BIGINT) AS pages, least(count(*), 101) AS first_row,
  least(count(*), 150) AS last_row FROM se""")
def page_info(spark, sf_dir):
    return views.page_info(sec_events(spark, sf_dir), 3)
