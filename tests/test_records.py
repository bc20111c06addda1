"""Parsing, defaults, headers, quality rules and scalar expressions on edge rows."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_values, record, rows
from vigilog import schema as S
from vigilog.functions import codes, ip, numbers, text, times
from vigilog.operators import parsing, quality, stats, views
from vigilog.session import scratch_dir
from vigilog.sources import kafka


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_unreadable_records_become_dead_letters(spark):
    parsed = parsing.parse_value(as_values(spark, [record(0), "{bad", "null", "[]", "", "17", '"text"', record(7)]))
    assert [r.event_id for r in parsing.good_records(parsed).orderBy("arrival_seq").collect()] == ["id-0", "id-7"]
    dead = {r.arrival_seq: r.raw for r in parsing.dead_letters(parsed).collect()}
    assert dead == {1: "{bad", 2: "null", 3: "[]", 4: "", 5: "17", 6: '"text"'}


def test_good_and_dead_split_all_records(spark):
    values = as_values(spark, [record(0), "{bad", record(1), "[1"]).unionByName(
        spark.createDataFrame([(9, None)], "arrival_seq long, value binary"))
    parsed = parsing.parse_value(values)
    assert parsing.good_records(parsed).count() + parsing.dead_letters(parsed).count() == 5


def test_all_fields_survive_a_round_trip(spark):
    original = record(3, tags=["a", "b"], additional_info={"n": 3, "ok": True, "list": ["x", "y"]})
    e = parsing.with_time(parsing.good_records(parsing.parse_value(as_values(spark, [original]))))
    assert json.loads(e.select(parsing.wire_json(e).alias("v")).first()["v"]) == original


def test_missing_fields_are_written_as_null(spark):
    e = parsing.with_time(parsing.parse_value(as_values(spark, ['{"event_id":"x","timestamp":"2025-04-13T21:59:52Z"}'])))
    back = json.loads(e.select(parsing.wire_json(e).alias("v")).first()["v"])
    assert set(back) == set(S.WIRE_FIELDS)
    assert back["session_id"] is None and back["timestamp"] == "2025-04-13T21:59:52.000000Z"


def test_mixed_details_keep_their_text(spark):
    m = one(spark, parsing.info_map(F.lit('{"a":1,"b":true,"c":["x"]}')))
    assert m == {"a": "1", "b": "true", "c": '["x"]'}


def test_typed_details(spark):
    events = [record(0, "PERMISSION_CHANGE", additional_info={"target_user": "user_1", "permissions": ["read", "write"]}),
              record(1, "MFA_CHALLENGE", additional_info={"mfa_type": "sms", "success": False, "attempt_number": 2})]
    parsed = parsing.parse_value(as_values(spark, events))
    assert parsing.typed_info(parsed, "PERMISSION_CHANGE").first()["permission_change"]["permissions"] == ["read", "write"]
    both = parsing.typed_info(parsed, "MFA_CHALLENGE", "PERMISSION_CHANGE").orderBy("arrival_seq").collect()
    mfa = both[1]["mfa_challenge"]
    assert (mfa["success"], mfa["attempt_number"]) == (False, 2)
    assert both[0]["mfa_challenge"] is None and both[1]["permission_change"] is None
    assert set(S.INFO_SCHEMAS) == set(S.EVENT_TYPES)


def test_defaults(spark):
    values = as_values(spark, ['{"event_type":"LOGOUT"}', '{"event_id":"e"}', '{"event_type":"EventType.LOGOUT",'
                               '"severity":"Severity.HIGH","geo_location":{}}', '{"geo_location":null}'])
    filled = parsing.fill_defaults(parsing.parse_value(values)).orderBy("arrival_seq")
    a, b, c, d = filled.collect()
    again = parsing.fill_defaults(parsing.parse_value(values)).orderBy("arrival_seq").first()
    assert a.event_id == again.event_id and len(a.event_id) == 64
    assert (a.event_type, a.severity, a.user_id, a.message) == ("LOGOUT", "INFO", "", "")
    assert (b.event_id, b.event_type) == ("e", "UNKNOWN")
    assert (c.event_type, c.severity, c.geo_location.country) == ("LOGOUT", "HIGH", "Unknown")
    assert d.geo_location is None


def test_country_counts_skip_events_without_location(spark):
    values = as_values(spark, [record(0), record(1, geo_location=None), record(2, geo_location={})])
    parsed = parsing.parse_value(values)
    assert rows(stats.count_by_country(parsed)) == [("Rwanda", 1), ("Unknown", 1)]
    assert stats.event_totals(parsed).first().events == 3


def test_times(spark):
    raw = ["2025-04-13T21:59:52.613552Z", "2025-04-13T21:59:52Z", "bad", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, timestamp string")
    assert [r.i for r in parsing.valid_timestamps(df).orderBy("i").collect()] == [0, 1]
    clock = df.orderBy("i").select(times.clock_text(F.col("timestamp")).alias("t")).collect()
    assert [r.t for r in clock] == ["21:59:52", "21:59:52", "bad", ""]
    ts = times.parse_iso(F.lit("2025-04-13T21:59:52.613500Z"))
    assert one(spark, times.epoch_text(ts)) == "1744581592.6135"
    assert one(spark, times.epoch_text(times.parse_iso(F.lit("2025-04-13T21:59:52Z")))) == "1744581592.0"


def test_locations(spark):
    geo = "struct<country:string,city:string>"
    cases = [(None, "Unknown", ""), ({"country": "A", "city": "B"}, "B, A", "A, B"),
             ({"country": "A", "city": None}, "A", "A, "), ({"country": None, "city": None}, "Unknown", "")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, g {geo}")
    got = df.orderBy("i").select(text.city_country(F.col("g")), text.country_city(F.col("g"))).collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]


def test_private_ranges(spark):
    cases = {"10.0.0.0": True, "10.255.255.255": True, "172.15.255.255": False, "172.16.0.0": True,
             "172.31.255.255": True, "172.32.0.0": False, "192.168.0.0": True, "192.169.0.0": False, "x": None,
             "1.2.3": None, "1.2.3.256": None, "1.2.3.4.5": None, None: None}
    df = ip.with_ip_columns(spark.createDataFrame([(k,) for k in cases], "ip_address string"))
    assert {r.ip_address: r.internal for r in df.collect()} == cases
    assert one(spark, ip.ip_to_long(F.lit("192.168.1.2"))) == 3232235778
    assert one(spark, ip.long_to_ip(F.lit(3232235778).cast("bigint"))) == "192.168.1.2"


def test_severity_outside_the_domain(spark):
    assert one(spark, codes.severity_rank(F.lit("FATAL"))) == 0
    assert one(spark, codes.severity_rank(F.lit(None).cast("string"))) == 0
    assert one(spark, codes.log_level(F.lit("FATAL"))) == "INFO"
    parsed = parsing.parse_value(as_values(spark, [record(0, severity="FATAL")]))
    assert quality.with_violations(parsed).first().violations == ["bad_severity"]


def test_contract(spark):
    events = [record(0), record(1, ip_address=None, user_type="ROBOT"), record(2, geo_location={"city": "X"}),
              record(3, timestamp="bad"), record(4, status_code=None), record(5, timestamp=None)]
    parsed = parsing.parse_value(as_values(spark, events))
    valid, invalid = quality.split_valid(parsed)
    assert sorted(r.event_id for r in valid.collect()) == ["id-0", "id-5"]
    assert {r.event_id: r.violations for r in invalid.collect()} == {
        "id-1": ["missing_ip_address", "bad_user_type"], "id-2": ["missing_country"],
        "id-3": ["bad_timestamp"], "id-4": ["missing_status_code"]}
    counts = {r.rule: r.n for r in quality.violation_counts(parsed).collect()}
    assert counts["bad_user_type"] == 1 and counts["missing_message"] == 0


def test_conformance(spark):
    events = [
        record(0, "MFA_CHALLENGE", "LOW", status_code=401, additional_info={"success": False}),
        record(1, "MFA_CHALLENGE", "LOW", status_code=200, additional_info={"success": False}),
        record(2, "UNAUTHORIZED_ACCESS", "HIGH", status_code=403, tags=["authorization", "admin"], user_type="CUSTOMER"),
        record(3, "LOGIN_SUCCESS", "HIGH"), record(4, "NEW_TYPE", "HIGH", status_code=9), record(5, tags=None)]
    parsed = parsing.parse_value(as_values(spark, events))
    checked = quality.with_violations(parsed, quality.conformance_rules(parsed.columns))
    assert {r.event_id: r.violations for r in checked.collect()} == {
        "id-0": [], "id-1": ["status_not_of_type"], "id-2": ["user_tag_differs"], "id-3": ["severity_not_of_type"],
        "id-4": [], "id-5": []}


def test_every_type_has_category_status_and_severities(spark):
    df = spark.createDataFrame([(t,) for t in S.EVENT_TYPES if t != "MFA_CHALLENGE"], "t string")
    r = df.agg(F.count(codes.event_category(F.col("t"))), F.count(codes.severity_in_domain(F.col("t"), F.lit("INFO"))),
               F.count(codes.expected_status(F.col("t"), F.lit(None).cast("boolean")))).first()
    assert tuple(r) == (14, 14, 14)


def test_log_lines(spark):
    e = parsing.parse_value(as_values(spark, [
        record(4, "UNAUTHORIZED_ACCESS", "HIGH", session_id=None, status_code=403, tags=[],
               additional_info={"resource": "/api", "n": 3}), record(5)]))
    lines = [r.l for r in e.orderBy("arrival_seq").select(parsing.log_line().alias("l")).collect()]
    assert lines[0] == ("UNAUTHORIZED_ACCESS: User user_4 (EMPLOYEE) from Kigali, Rwanda | IP: 10.0.0.4 | Session: N/A | "
                        "Status: 403 | Severity: HIGH | Tags: ")
    severe = parsing.severe_lines(e).collect()
    assert len(severe) == 1 and severe[0].log_level == "ERROR"
    assert severe[0].detail.startswith("DETAILS: text | Source: web-portal | Target: auth-service | Additional Info: {")
    assert '"n": 3' in severe[0].detail or '"n":3' in severe[0].detail


def test_headers(spark):
    e = parsing.with_time(parsing.parse_value(as_values(spark, [record(1, source_system=None, correlation_id=None)])))
    made = parsing.kafka_record(e)
    assert made.schema.simpleString() == S.KAFKA_RECORD.simpleString()
    r = made.first()
    assert bytes(r.key) == b"user_1"
    assert [(h.key, bytes(h.value)) for h in r.headers] == [
        ("schema-version", b"1.0.0"), ("event-type", b"LOGIN_SUCCESS"), ("severity", b"INFO"), ("source", b"unknown"),
        ("timestamp", b"1744578001.000001"), ("correlation-id", b"")]
    prefixed = spark.createDataFrame([([("event-type", bytearray(b"EventType.LOGOUT"))],), ([],), (None,)],
                                     "headers array<struct<key:string,value:binary>>")
    got = prefixed.select(parsing.enum_header(F.col("headers"), "event-type").alias("t")).collect()
    assert [x.t for x in got] == ["LOGOUT", None, None]


def test_severe_records_by_header(spark):
    heads = [[("severity", bytearray(b"Severity.HIGH"))], [("severity", bytearray(b"INFO"))], []]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i int, headers array<struct<key:string,value:binary>>")
    assert [r.i for r in kafka.severe_records(df).orderBy("i").collect()] == [0, 2]


def test_kafka_arrival_order_spans_partitions(spark):
    """The newest records of a topic are those received last, whatever their partitions' lengths."""
    rows = [(p, o, f"2025-01-01 00:00:{(o * 4 + p) % 60:02d}") for p, n in enumerate((3, 9, 1, 6)) for o in range(n)]
    df = spark.createDataFrame(rows, "partition int, offset long, t string").withColumn("timestamp", F.col("t").cast("timestamp"))
    got = [(r.partition, r.offset) for r in views.retain_last(kafka.arrival_seq(df), 5).collect()]
    assert set(got) == {x[:2] for x in sorted(rows, key=lambda r: (r[2], r[0], r[1]))[-5:]}


def test_kafka_source_options():
    o = kafka.source_options("h:9092", "t", from_beginning=False, max_per_trigger=10, min_per_trigger=10)
    assert o["startingOffsets"] == "latest" and o["subscribe"] == "t" and o["failOnDataLoss"] == "true"
    assert (o["maxOffsetsPerTrigger"], o["minOffsetsPerTrigger"], o["maxTriggerDelay"]) == ("10", "10", "2s")
    assert kafka.source_options("h:9092", "t")["startingOffsets"] == "earliest"


def test_display_rules(spark):
    got = {t: one(spark, codes.display_category(F.lit(t))) for t in
           ["LOGIN_SUCCESS", "MFA_CHALLENGE", "DATA_EXFILTRATION", "DATA_ACCESS", "CONFIG_CHANGE", "PASSWORD_CHANGE"]}
    assert list(got.values()) == ["green", "yellow", "red", "blue", "cyan", "white"]
    modes = [one(spark, codes.rate_mode(F.lit(n))) for n in (30, 31, 100, 101)]
    assert modes == ["Slow Mode", "Normal Rate", "Normal Rate", "High Rate"]
    assert one(spark, text.two_decimals(F.lit(1.005e2))) == "100.50"
    assert one(spark, numbers.ratio(F.lit(3), F.lit(0))) == 0.0
    assert one(spark, numbers.page_count(F.lit(101), 50)) == 3


def test_empty_input(spark):
    empty = parsing.with_time(parsing.parse_value(as_values(spark, [record(0)]))).filter("false")
    assert stats.throughput(empty).first().per_second == 0.0
    assert stats.success_rate(empty, F.lit(True)).first().success_pct == 0.0
    assert rows(stats.distributions(empty)) == []
    assert stats.activity_timeline(empty).count() == 0
    assert stats.severity_share(empty).count() == 0
    assert views.page_info(empty, 1).first().pages == 0


def test_timeline_needs_more_than_five_events(spark):
    e = parsing.with_time(parsing.parse_value(as_values(spark, [record(i) for i in range(6)])))
    assert stats.activity_timeline(e).count() == 1
    assert stats.activity_timeline(e.filter("arrival_seq < 5")).count() == 0
    later = F.lit("2025-04-13T21:30:00.000001Z").cast("timestamp")
    assert stats.activity_timeline(e, as_of=later).first().n == 5


def test_brief_parse_reads_nine_fields(spark):
    parsed = parsing.parse_value(as_values(spark, [record(0)]), schema=S.BRIEF_EVENT)
    assert len(S.BRIEF_EVENT) == 9 and parsed.first().source_system == "web-portal"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session, "x")


def test_null_keys_in_a_statistics_document(spark):
    from vigilog.operators import stats
    table = spark.createDataFrame([("event_type", None, 3), ("event_type", "LOGOUT", 2), ("severity", None, 5), ("total", "total", 5)],
                                  "dimension string, key string, n long")
    back = stats.read_stats_document(stats.stats_document(table))
    assert {(r.dimension, r.key): r.n for r in back.collect()} == {
        ("event_type", None): 3, ("event_type", "LOGOUT"): 2, ("severity", None): 5, ("total", "total"): 5}


def test_sketches_merge_to_the_union(spark):
    from vigilog.operators import stats
    def part(low, high):
        return spark.range(low, high).selectExpr("concat('v', id) AS user_id", "CAST(NULL AS STRING) AS session_id")
    columns = ("user_id", "session_id")
    merged = stats.merge_sketches(*[stats.distinct_sketches(part(a, b), columns) for a, b in ((0, 4000), (3000, 9000), (0, 10))])
    found = {r.dimension: r.n for r in stats.distinct_estimates(merged).collect()}
    assert abs(found["user_id"] - 9000) <= 0.02 * 9000 and found["session_id"] == 0
