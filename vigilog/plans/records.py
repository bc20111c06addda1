"""Records: scanning, parsing, checking, and per-row expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilog import schema as S
from vigilog.functions import codes, ip, text, times
from vigilog.operators import parsing, quality, stats, views
from vigilog.plans.registry import query
from vigilog.plans.tables import located_events, se_cte, sec_events, wire_records
from vigilog.session import scratch_dir
from vigilog.sources import files

SE = se_cte()
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
CATEGORY = """CASE
  WHEN event_type IN ('LOGIN_SUCCESS', 'LOGIN_FAILURE', 'LOGOUT', 'PASSWORD_CHANGE', 'MFA_CHALLENGE', 'ACCOUNT_LOCKOUT')
    THEN 'authentication'
  WHEN event_type IN ('UNAUTHORIZED_ACCESS', 'PRIVILEGE_ESCALATION', 'PERMISSION_CHANGE') THEN 'authorization'
  WHEN event_type IN ('DATA_ACCESS', 'DATA_MODIFICATION', 'DATA_EXFILTRATION') THEN 'data'
  ELSE 'system' END"""
TAGS = f"""concat({CATEGORY}, ', ', lower(user_type),
  CASE WHEN event_type IN ('PRIVILEGE_ESCALATION', 'DATA_EXFILTRATION') THEN ', security-threat' ELSE '' END,
  CASE WHEN event_type IN ('ACCOUNT_LOCKOUT', 'LOGIN_FAILURE') THEN ', security-alert' ELSE '' END)"""
LEVEL = """CASE WHEN severity = 'MEDIUM' THEN 'WARNING' WHEN severity = 'HIGH' THEN 'ERROR'
  WHEN severity = 'CRITICAL' THEN 'CRITICAL' ELSE 'INFO' END"""


def _info_sql(sorted_keys: bool = False) -> str:
    """Details as JSON text: keys as they were built, or sorted as a variant writes them."""
    failure = ("concat('{\"failure_reason\":\"reason_', k % 6, '\",\"attempt_number\":', k % 5 + 1, "
               "',\"device_type\":\"desktop\"}')")
    mfa = ("concat('{\"mfa_type\":\"app\",\"success\":', CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, "
           "',\"attempt_number\":', k % 3 + 1, '}')")
    if sorted_keys:
        failure = ("concat('{\"attempt_number\":', k % 5 + 1, ',\"device_type\":\"desktop\","
                   "\"failure_reason\":\"reason_', k % 6, '\"}')")
        mfa = ("concat('{\"attempt_number\":', k % 3 + 1, ',\"mfa_type\":\"app\",\"success\":', "
               "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, '}')")
    return (f"CASE WHEN event_type = 'LOGIN_FAILURE' THEN {failure} WHEN event_type = 'MFA_CHALLENGE' THEN {mfa} "
            "WHEN event_type = 'DATA_ACCESS' THEN concat('{\"data_type\":\"customer\",\"records_accessed\":', k * 10, '}') "
            "ELSE concat('{\"k\":', k, '}') END")


def _quoted(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN 'null' ELSE concat('\"', {col}, '\"') END"


INFO, WIRE_INFO = _info_sql(), _info_sql(sorted_keys=True)
JSON = f"""concat('{{"event_id":"', event_id, '","timestamp":"', {ISO}, '","event_type":"', event_type,
  '","user_id":"', user_id, '","user_type":"', user_type, '","ip_address":"', ip_address, '","geo_location":',
  CASE WHEN has_geo = 0 THEN 'null' ELSE concat('{{"country":', {_quoted('country')}, ',"city":', {_quoted('city')},
    ',"latitude":null,"longitude":null}}') END,
  ',"user_agent":"', user_agent, '","status_code":', status_code, ',"message":"', message,
  '","correlation_id":"', correlation_id, '","session_id":', {_quoted('session_id')}, ',"severity":"', severity,
  '","source_system":', {_quoted('source_system')}, ',"target_system":"', target_system,
  '","tags":["', replace({TAGS}, ', ', '","'), '"],"additional_info":', {WIRE_INFO}, '}}')"""
LOCATION = """CASE WHEN has_geo = 0 THEN 'Unknown' WHEN coalesce(city, '') <> '' THEN concat(city, ', ', coalesce(country, ''))
  ELSE coalesce(country, 'Unknown') END"""
COUNTRY_CITY = """CASE WHEN has_geo = 1 AND (country IS NOT NULL OR city IS NOT NULL)
  THEN concat(coalesce(country, ''), ', ', coalesce(city, '')) ELSE '' END"""
LINE = f"""concat(event_type, ': User ', user_id, ' (', user_type, ') from ', {LOCATION}, ' | IP: ', ip_address,
  ' | Session: ', coalesce(session_id, 'N/A'), ' | Status: ', status_code, ' | Severity: ', severity,
  ' | Tags: ', {TAGS})"""
WIRE_SQL = f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {ISO} AS "timestamp", event_type, user_id, user_type,
  ip_address, has_geo = 1 AS located, country, city, user_agent, status_code, message, correlation_id, session_id,
  severity, source_system, target_system, {TAGS} AS tags, {WIRE_INFO} AS additional_info
  FROM se WHERE event_id % 19 <> 0"""


def _flat(events):
    """The wire fields as plain columns, so that they can be compared."""
    geo = F.col("geo_location")
    return events.select(
        "event_id", "timestamp", "event_type", "user_id", "user_type", "ip_address",
        geo.isNotNull().alias("located"), geo["country"].alias("country"), geo["city"].alias("city"),
        "user_agent", "status_code", "message", "correlation_id", "session_id", "severity", "source_system",
        "target_system", text.join_tags(F.col("tags")).alias("tags"), "additional_info")


@query(SE + WIRE_SQL)
def scan_events(spark, sf_dir):
    """Event log written as JSON lines and scanned; unreadable lines are set apart."""
    path = scratch_dir(spark, "scan")
    wire_records(spark, sf_dir).select(F.col("value").cast("string")).write.text(path)
    return _flat(parsing.good_records(files.scan_events(spark, path)))


@query(SE + WIRE_SQL)
def parse_json(spark, sf_dir):
    return _flat(parsing.good_records(parsing.parse_value(wire_records(spark, sf_dir))))


@query(SE + f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {ISO} AS "timestamp", event_type, user_id, user_type,
  ip_address, severity, message, source_system FROM se WHERE event_id % 19 <> 0""")
def parse_brief(spark, sf_dir):
    """The nine-field parse of a light consumer."""
    parsed = parsing.parse_value(wire_records(spark, sf_dir), schema=S.BRIEF_EVENT)
    return parsing.good_records(parsed).select(*S.BRIEF_EVENT.fieldNames())


@query(SE + f"SELECT arrival_seq, concat('{{bad ', {JSON}) AS raw, 'unreadable record' AS reason "
       "FROM se WHERE event_id % 19 = 0")
def dead_letter(spark, sf_dir):
    return parsing.dead_letters(parsing.parse_value(wire_records(spark, sf_dir)))


@query(SE + """SELECT arrival_seq,
  CASE WHEN event_id % 17 = 0 THEN sha256(concat('raw-', arrival_seq)) ELSE CAST(event_id AS VARCHAR) END AS event_id,
  CASE WHEN event_id % 5 = 0 THEN 'UNKNOWN' ELSE event_type END AS event_type,
  CASE WHEN event_id % 7 = 0 THEN 'INFO' ELSE severity END AS severity,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE user_id END AS user_id,
  CASE WHEN has_geo = 1 THEN coalesce(country, 'Unknown') END AS country FROM se""")
def default_fill(spark, sf_dir):
    seq = F.col("arrival_seq")

    def lost(n, c):
        return F.when(seq % n != 0, F.col(c))
    damaged = located_events(spark, sf_dir).withColumns({
        "raw": F.concat(F.lit("raw-"), seq.cast("string")), "event_id": lost(17, "event_id").cast("string"),
        "event_type": F.concat(F.lit("EventType."), lost(5, "event_type")), "severity": lost(7, "severity"),
        "user_id": lost(3, "user_id")})
    return parsing.fill_defaults(damaged).select(
        "arrival_seq", "event_id", "event_type", "severity", "user_id", F.col("geo_location.country").alias("country"))


def _damaged_times(events):
    """Times as text: some unreadable, some missing, some without a fraction."""
    seq = F.col("arrival_seq") % 10
    return events.withColumn("timestamp", (
        F.when(seq == 0, F.lit("bad")).when(seq == 1, F.lit(None).cast("string"))
        .when(seq == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(times.iso_z(F.col("ts")))))


@query(SE + """SELECT event_id, CASE WHEN event_id % 10 = 2 THEN date_trunc('second', ts) ELSE ts END AS ts
  FROM se WHERE event_id % 10 >= 2 ORDER BY ts""")
def valid_timestamps(spark, sf_dir):
    """Events with a readable time, in time order."""
    timed = parsing.valid_timestamps(_damaged_times(sec_events(spark, sf_dir)))
    return timed.orderBy("ts", "arrival_seq").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(SE + f"""SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'bad' WHEN 1 THEN '' ELSE strftime(ts, '%H:%M:%S') END AS time,
  event_type AS type, severity, user_id AS "user", ip_address AS source_ip, {COUNTRY_CITY} AS location, message FROM se""")
def display_rows(spark, sf_dir):
    return views.display_rows(_damaged_times(located_events(spark, sf_dir)))


@query(SE + f"SELECT event_id, {JSON} AS value FROM se")
def event_to_json(spark, sf_dir):
    e = located_events(spark, sf_dir)
    as_text = e.withColumns({"seq": F.col("event_id"), "event_id": F.col("event_id").cast("string")})
    return as_text.select(F.col("seq").alias("event_id"), parsing.wire_json(as_text).alias("value"))


@query(SE + r"""SELECT event_id, user_id AS key, '1.0.0' AS schema_version, event_type, severity,
  coalesce(source_system, 'unknown') AS source, correlation_id,
  regexp_replace(printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000), '(\.\d+?)0+$', '\1') AS "timestamp"
  FROM se""")
def kafka_record(spark, sf_dir):
    """Records as they go to the topic, their headers read back by key."""
    record = parsing.kafka_record(located_events(spark, sf_dir))
    h = F.col("headers")
    return record.select(
        F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint").alias("event_id"),
        F.col("key").cast("string").alias("key"), parsing.header(h, "schema-version").alias("schema_version"),
        parsing.enum_header(h, "event-type").alias("event_type"), parsing.enum_header(h, "severity").alias("severity"),
        parsing.header(h, "source").alias("source"), parsing.header(h, "timestamp").alias("timestamp"),
        parsing.header(h, "correlation-id").alias("correlation_id"))


@query(SE + "SELECT event_id, k, country FROM se")
def json_extract(spark, sf_dir):
    """Fields out of JSON text and out of a nested column."""
    return located_events(spark, sf_dir).select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("geo_location.country").alias("country"))


@query(SE + """SELECT event_id, event_type, concat('reason_', k % 6) AS detail, k % 5 + 1 AS amount
  FROM se WHERE event_type = 'LOGIN_FAILURE'
  UNION ALL SELECT event_id, event_type, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, k % 3 + 1
  FROM se WHERE event_type = 'MFA_CHALLENGE'
  UNION ALL SELECT event_id, event_type, 'customer', k * 10 FROM se WHERE event_type = 'DATA_ACCESS'""")
def typed_info(spark, sf_dir):
    """Typed details of three event types."""
    typed = parsing.typed_info(sec_events(spark, sf_dir), "LOGIN_FAILURE", "MFA_CHALLENGE", "DATA_ACCESS")
    return typed.select(
        "event_id", "event_type",
        F.coalesce("login_failure.failure_reason", F.col("mfa_challenge.success").cast("string"),
                   "data_access.data_type").alias("detail"),
        F.coalesce("login_failure.attempt_number", "mfa_challenge.attempt_number",
                   "data_access.records_accessed").alias("amount"))


@query(SE + f"SELECT event_id, {LINE} AS line FROM se")
def log_line(spark, sf_dir):
    return located_events(spark, sf_dir).select("event_id", parsing.log_line().alias("line"))


@query(SE + f"""SELECT event_id, {LEVEL} AS log_level, {LINE} AS line,
  concat('DETAILS: ', message, ' | Source: ', coalesce(source_system, 'None'), ' | Target: ', target_system,
         ' | Additional Info: ', {INFO}) AS detail
  FROM se WHERE severity IN ('HIGH', 'CRITICAL')""")
def route_high_severity(spark, sf_dir):
    return parsing.severe_lines(located_events(spark, sf_dir))


@query(SE + "SELECT event_id, event_type, severity FROM se")
def strip_prefix(spark, sf_dir):
    """Half of the values carry the prefix of their enumeration."""
    def prefixed(name, c):
        return F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(name + "."), F.col(c))).otherwise(F.col(c))
    e = sec_events(spark, sf_dir)
    return e.select("event_id", text.strip_enum_prefix(prefixed("EventType", "event_type")).alias("event_type"),
                    text.strip_enum_prefix(prefixed("Severity", "severity")).alias("severity"))


@query(SE + f"SELECT event_id, severity, {LEVEL} AS log_level FROM se")
def severity_log_level(spark, sf_dir):
    return sec_events(spark, sf_dir).select(
        "event_id", "severity", codes.log_level(F.col("severity")).alias("log_level"))


@query(SE + """SELECT event_id, event_type, CASE
  WHEN event_type IN ('LOGIN_SUCCESS', 'LOGOUT') THEN 'green'
  WHEN event_type IN ('LOGIN_FAILURE', 'ACCOUNT_LOCKOUT', 'MFA_CHALLENGE') THEN 'yellow'
  WHEN event_type IN ('UNAUTHORIZED_ACCESS', 'PRIVILEGE_ESCALATION', 'DATA_EXFILTRATION') THEN 'red'
  WHEN event_type IN ('DATA_ACCESS', 'DATA_MODIFICATION') THEN 'blue'
  WHEN event_type IN ('SYSTEM_STARTUP', 'SYSTEM_SHUTDOWN', 'CONFIG_CHANGE') THEN 'cyan' ELSE 'white' END AS category,
  CASE severity WHEN 'INFO' THEN 'green' WHEN 'LOW' THEN 'blue' WHEN 'MEDIUM' THEN 'yellow' WHEN 'HIGH' THEN 'red'
    ELSE 'magenta' END AS color FROM se""")
def display_category(spark, sf_dir):
    return sec_events(spark, sf_dir).select(
        "event_id", "event_type", codes.display_category(F.col("event_type")).alias("category"),
        codes.severity_color(F.col("severity")).alias("color"))


@query(SE + f"SELECT event_id, {CATEGORY} AS category FROM se")
def event_category(spark, sf_dir):
    return sec_events(spark, sf_dir).select("event_id", codes.event_category(F.col("event_type")).alias("category"))


@query(SE + f"SELECT event_id, {TAGS} AS tags FROM se")
def derive_tags(spark, sf_dir):
    tags = codes.derive_tags(F.col("event_type"), F.col("user_type"))
    return sec_events(spark, sf_dir).select("event_id", text.join_tags(tags).alias("tags"))


@query(SE + f"SELECT tag, count(*) AS n FROM (SELECT unnest(string_split({TAGS}, ', ')) AS tag FROM se) t GROUP BY tag")
def tag_counts(spark, sf_dir):
    return stats.tag_counts(sec_events(spark, sf_dir))


IP_LONG = """CAST(split_part(ip_address, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip_address, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(ip_address, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip_address, '.', 4) AS BIGINT)"""


@query(SE + f"SELECT event_id, {IP_LONG} AS ip_long, ip_address AS ip_text FROM se")
def ip_to_long(spark, sf_dir):
    e = ip.with_ip_columns(sec_events(spark, sf_dir))
    return e.select("event_id", "ip_long", ip.long_to_ip(F.col("ip_long")).alias("ip_text"))


@query(SE + """SELECT user_type, user_num % 4 <> 3 AS internal, count(*) AS n FROM se GROUP BY 1, 2""")
def internal_external(spark, sf_dir):
    e = ip.with_ip_columns(sec_events(spark, sf_dir))
    return e.groupBy("user_type", "internal").agg(F.count(F.lit(1)).alias("n"))


def _counter(rule: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) AS n FROM se WHERE {condition}"


@query(SE + " UNION ALL ".join(_counter(*r) for r in [
    ("missing_event_id", "false"), ("missing_event_type", "event_id % 17 = 0"),
    ("missing_user_id", "event_id % 29 = 0"), ("missing_ip_address", "false"), ("missing_user_agent", "false"),
    ("missing_status_code", "false"), ("missing_message", "false"), ("bad_event_type", "false"),
    ("bad_user_type", "event_id % 37 = 0"), ("bad_severity", "event_id % 23 = 0"),
    ("bad_timestamp", "event_id % 10 = 0"), ("missing_country", "has_geo = 1 AND country IS NULL")]))
def validate_events(spark, sf_dir):
    """Violations of the record contract on a damaged log."""
    seq = F.col("arrival_seq")
    damaged = _damaged_times(located_events(spark, sf_dir)).withColumns({
        "event_type": F.when(seq % 17 != 0, F.col("event_type")),
        "user_id": F.when(seq % 29 != 0, F.col("user_id")),
        "user_type": F.when(seq % 37 == 0, F.lit("ROBOT")).otherwise(F.col("user_type")),
        "severity": F.when(seq % 23 == 0, F.lit("FATAL")).otherwise(F.col("severity"))})
    return quality.violation_counts(damaged)


@query(SE + """SELECT event_type, count(*) AS events, CAST(sum(CASE WHEN event_id % 17 = 0 AND event_type NOT IN
  ('LOGIN_SUCCESS', 'LOGOUT', 'DATA_ACCESS', 'SYSTEM_STARTUP', 'SYSTEM_SHUTDOWN') THEN 1 ELSE 0 END) AS BIGINT) AS violations
  FROM se GROUP BY event_type""")
def severity_conformance(spark, sf_dir):
    """Per type, events whose severity the type does not allow; every 17th severity is set to INFO."""
    damaged = sec_events(spark, sf_dir).withColumn(
        "severity", F.when(F.col("event_id") % 17 == 0, F.lit("INFO")).otherwise(F.col("severity")))
    rule = quality.conformance_rules(["event_type", "severity"])["severity_not_of_type"]
    return damaged.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_if(rule).alias("violations"))


@query(SE + " UNION ALL ".join(_counter(*r) for r in [
    ("severity_not_of_type", "false"), ("status_not_of_type", "event_id % 19 = 0 AND status_code <> 200"),
    ("category_tag_missing", f"event_id % 21 = 0 AND NOT ({CATEGORY} = 'system' AND user_type = 'SYSTEM')"),
    ("user_tag_differs", "event_id % 31 = 0 AND user_type <> 'ADMIN'")]))
def conformance(spark, sf_dir):
    """Checks between fields on a damaged log."""
    seq = F.col("event_id")
    damaged = sec_events(spark, sf_dir).withColumns({
        "status_code": F.when(seq % 19 == 0, F.lit(200)).otherwise(F.col("status_code")),
        "tags": F.when(seq % 21 == 0, F.slice("tags", 2, 10))
        .otherwise(F.col("tags")),
        "user_type": F.when(seq % 31 == 0, F.lit("ADMIN")).otherwise(F.col("user_type"))})
    return quality.violation_counts(damaged, quality.conformance_rules(damaged.columns))
