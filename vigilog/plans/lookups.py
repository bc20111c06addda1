"""Users, sessions and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilog.operators import correlation, enrich, sessions
from vigilog.plans.registry import query
from vigilog.plans.tables import se_cte, sec_events, table

SE = se_cte()
SESSIONS = """SELECT session_id, min(CASE WHEN event_type = 'LOGIN_SUCCESS' THEN ts END) AS created_at,
  max(CASE WHEN event_type = 'LOGOUT' THEN ts END) AS ended_at,
  min(CASE WHEN event_type = 'LOGIN_SUCCESS' THEN ts END) + INTERVAL 8 HOURS AS expires_at,
  min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS events,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds
  FROM se WHERE session_id IS NOT NULL GROUP BY session_id"""


def user_table(spark, sf_dir):
    """User dimension from the customer table."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "c_nationkey")


def place_table(spark, sf_dir):
    return (table(spark, sf_dir, "nation")
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"),
                    F.col("r_name").alias("region")))


@query(SE + """SELECT event_id, user_id, c2.c_name AS name, c2.c_mktsegment AS segment, n2.n_name AS nation, r_name AS region
  FROM se LEFT JOIN customer c2 ON user_num = c2.c_custkey LEFT JOIN nation n2 ON c2.c_nationkey = n2.n_nationkey
  LEFT JOIN region ON n2.n_regionkey = r_regionkey""")
def enrich_user(spark, sf_dir):
    """Profile and place of the user, joined one after the other: each side is judged by its own size."""
    e = sec_events(spark, sf_dir).select("event_id", "user_id")
    profiled = enrich.enrich_users(e, user_table(spark, sf_dir))
    return profiled.join(place_table(spark, sf_dir), "c_nationkey", "left").drop("c_nationkey")


@query(SE + f"""SELECT event_id, se.session_id, coalesce(ts BETWEEN created_at AND least(expires_at, CASE WHEN ended_at >= created_at THEN ended_at END), false) AS live,
  CASE WHEN ts BETWEEN created_at AND least(expires_at, CASE WHEN ended_at >= created_at THEN ended_at END) THEN created_at END AS session_start
  FROM se LEFT JOIN ({SESSIONS}) s ON se.session_id = s.session_id""")
def session_lookup(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("event_id", "session_id", "event_type", "ts")
    return sessions.session_lookup(e).select("event_id", "session_id", "live", "session_start")


@query(SE + """SELECT event_id, correlation_id, prev_event_id, prev_event_type FROM (SELECT *,
    lag(event_id) OVER w AS prev_event_id, lag(event_type) OVER w AS prev_event_type
    FROM se WINDOW w AS (PARTITION BY correlation_id ORDER BY arrival_seq)) t WHERE prev_event_id IS NOT NULL""")
def correlated_pairs(spark, sf_dir):
    """Each event with the one before it in its chain."""
    e = sec_events(spark, sf_dir).select("event_id", "arrival_seq", "correlation_id", "event_type", "ts")
    return correlation.linked_pairs(e).select("event_id", "correlation_id", "prev_event_id", "prev_event_type")


@query(SE + """SELECT correlation_id, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types FROM se GROUP BY correlation_id""")
def correlation_chains(spark, sf_dir):
    return correlation.chains(sec_events(spark, sf_dir)).withColumn("event_types", F.array_join("event_types", ","))


@query(SE + f"""SELECT *, CASE WHEN created_at IS NULL THEN 'unopened' WHEN ended_at >= created_at THEN 'closed'
  WHEN expires_at < (SELECT max(ts) FROM se) THEN 'expired' ELSE 'active' END AS state FROM ({SESSIONS}) t""")
def session_summary(spark, sf_dir):
    e = sec_events(spark, sf_dir)
    return sessions.session_state(sessions.session_summary(e), e.agg(F.max("ts")).scalar())


@query(SE + """SELECT user_id, session_no, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS events FROM (
    SELECT user_id, ts, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, arrival_seq) AS BIGINT) AS session_no
    FROM (SELECT user_id, ts, arrival_seq, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER
            (PARTITION BY user_id ORDER BY ts, arrival_seq)) <= 21600000000 THEN 0 ELSE 1 END AS fresh FROM se) a) b
  GROUP BY user_id, session_no""")
def session_gaps(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("user_id", "ts", "arrival_seq")
    return sessions.gap_sessions(e, gap_seconds=6 * 3600)


@query(SE + """SELECT session_id, count(DISTINCT user_id) AS users FROM se WHERE session_id IS NOT NULL
  GROUP BY session_id HAVING count(DISTINCT user_id) > 1""")
def session_identity(spark, sf_dir):
    return sessions.shared_sessions(sec_events(spark, sf_dir))
