"""The given tables seen as a security-event log.

``EVENT_SQL`` is plain SQL that Spark and other engines read alike; the
queries run on the DataFrame, the checks embed the same text as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions import codes
from vigilog.operators import parsing
from vigilog.session import configure

# Type and user shares follow the weights 40, 20, 20, 5, 10, 5,
# 10, 2, 5, 15, 5, 1, 1, 1, 2 of the 15 types and 60, 15, 10, 10, 30, 5 of
# the 6 user types.
EVENT_SQL = """
SELECT event_id, event_id AS arrival_seq, ts, event_type, user_num, concat('user_', cast(user_num AS string)) AS user_id,
  user_type, severity,
  concat(CASE user_num % 4 WHEN 0 THEN '10.0' WHEN 1 THEN '172.16' WHEN 2 THEN '192.168' ELSE '84.232' END, '.',
         cast(user_num % 250 AS string), '.', cast(event_id % 250 AS string)) AS ip_address,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS has_geo,
  value, props, k,
  CASE WHEN event_type = 'LOGIN_FAILURE' THEN 401 WHEN event_type IN ('UNAUTHORIZED_ACCESS', 'ACCOUNT_LOCKOUT') THEN 403
       WHEN event_type IN ('PRIVILEGE_ESCALATION', 'DATA_EXFILTRATION') THEN 400
       WHEN event_type = 'MFA_CHALLENGE' AND k % 2 = 1 THEN 401 ELSE 200 END AS status_code,
  concat('event ', event_type, ' number ', cast(k AS string)) AS message,
  concat('agent/', cast(k % 7 AS string)) AS user_agent,
  concat('corr_', cast(cast(floor(event_id / 4) AS bigint) AS string)) AS correlation_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE
    concat('sess_', cast(cast(floor(user_num / 2) AS bigint) AS string), '_', cast(cast(ts AS date) AS string)) END AS session_id,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat('system_', cast(event_id % 10 AS string)) END AS source_system,
  concat('system_', cast(k % 10 AS string)) AS target_system
FROM (
  SELECT e.event_id, e.ts, e.user_id AS user_num, e.value, e.props, e.k,
    CASE WHEN h < 40 THEN 'LOGIN_SUCCESS' WHEN h < 60 THEN 'LOGIN_FAILURE' WHEN h < 80 THEN 'LOGOUT'
         WHEN h < 85 THEN 'PASSWORD_CHANGE' WHEN h < 95 THEN 'MFA_CHALLENGE' WHEN h < 100 THEN 'ACCOUNT_LOCKOUT'
         WHEN h < 110 THEN 'UNAUTHORIZED_ACCESS' WHEN h < 112 THEN 'PRIVILEGE_ESCALATION' WHEN h < 117 THEN 'PERMISSION_CHANGE'
         WHEN h < 132 THEN 'DATA_ACCESS' WHEN h < 137 THEN 'DATA_MODIFICATION' WHEN h < 138 THEN 'DATA_EXFILTRATION'
         WHEN h < 139 THEN 'SYSTEM_STARTUP' WHEN h < 140 THEN 'SYSTEM_SHUTDOWN' ELSE 'CONFIG_CHANGE' END AS event_type,
    CASE WHEN u < 60 THEN 'EMPLOYEE' WHEN u < 75 THEN 'CONTRACTOR' WHEN u < 85 THEN 'ADMIN' WHEN u < 95 THEN 'SYSTEM'
         WHEN u < 125 THEN 'CUSTOMER' ELSE 'ANONYMOUS' END AS user_type,
    CASE WHEN (h >= 95 AND h < 100) OR (h >= 110 AND h < 112) OR h = 137 THEN CASE WHEN b = 0 THEN 'HIGH' ELSE 'CRITICAL' END
         WHEN (h >= 40 AND h < 60) OR (h >= 100 AND h < 110) OR (h >= 112 AND h < 117) OR (h >= 132 AND h < 137)
              THEN CASE WHEN b = 0 THEN 'MEDIUM' ELSE 'HIGH' END
         WHEN (h >= 80 AND h < 95) OR h >= 140 THEN CASE WHEN b = 0 THEN 'LOW' ELSE 'MEDIUM' END
         ELSE 'INFO' END AS severity
  FROM (SELECT *, (event_id * 7919 + user_id * 31) % 142 AS h, (user_id * 17) % 130 AS u,
               (event_id * 13 + user_id) % 2 AS b, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k
        FROM {events}) e
) x
"""
LOCATED_SQL = """
SELECT x.*,
  CASE WHEN has_geo = 0 OR event_id % 29 = 0 THEN NULL ELSE n.n_name END AS country,
  CASE WHEN has_geo = 0 OR event_id % 31 = 0 THEN NULL ELSE c.c_name END AS city
FROM {flat} x
LEFT JOIN {customer} c ON c.c_custkey = x.user_num
LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_table(events: DataFrame) -> DataFrame:
    """Event table without locations: a projection of the source rows, no join."""
    return events.sparkSession.sql(EVENT_SQL, events=events).withColumns({
        "tags": codes.derive_tags(F.col("event_type"), F.col("user_type")),
        "additional_info": info_json(),
    })


def located(flat: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Add the location of the user. Only queries that need it pay for the joins."""
    geo = F.struct("country", "city", F.lit(None).cast("double").alias("latitude"),
                   F.lit(None).cast("double").alias("longitude"))
    return (flat.sparkSession.sql(LOCATED_SQL, flat=flat, customer=customer, nation=nation)
            .withColumn("geo_location", F.when(F.col("has_geo") == 1, geo)).drop("country", "city"))


def info_json():
    """Details by event type from the value ``k`` of the source row; typed, as JSON text."""
    k = F.col("k")

    def doc(**fields):
        return F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]))
    kind = F.col("event_type")
    return (F.when(kind == "LOGIN_FAILURE", doc(failure_reason=F.concat(F.lit("reason_"), (k % 6).cast("string")),
                                                attempt_number=k % 5 + 1, device_type=F.lit("desktop")))
            .when(kind == "MFA_CHALLENGE", doc(mfa_type=F.lit("app"), success=k % 2 == 0, attempt_number=k % 3 + 1))
            .when(kind == "DATA_ACCESS", doc(data_type=F.lit("customer"), records_accessed=k * 10))
            .otherwise(doc(k=k)))


def sec_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table(table(spark, sf_dir, "events"))


def located_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(sec_events(spark, sf_dir), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


def as_records(events: DataFrame) -> DataFrame:
    """Events as they would arrive: ``arrival_seq`` and the JSON ``value``; every 19th record is broken."""
    e = events.withColumn("event_id", F.col("event_id").cast("string"))
    damage = F.when(F.col("arrival_seq") % 19 == 0, F.lit("{bad ")).otherwise(F.lit(""))
    return e.select("arrival_seq", F.concat(damage, parsing.wire_json(e)).cast("binary").alias("value"))


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(located_events(spark, sf_dir))


def se_cte(also: str = "") -> str:
    """The event log as the head of a query: ``WITH se AS (...)``; ``also`` adds further named tables."""
    flat = "(" + EVENT_SQL.format(events="events") + ")"
    whole = LOCATED_SQL.format(flat=flat, customer="customer", nation="nation")
    return "WITH se AS (" + whole + ")" + also + "\n"
