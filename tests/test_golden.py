"""A recorded run: 56 events went in, 30 were accepted within one window."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vigilog.operators import sampling, stats

SEVERITY = {"I": "INFO", "L": "LOW", "M": "MEDIUM", "H": "HIGH", "C": "CRITICAL"}
SEVERITIES = "IMIIHHMIIMCIHMHHIHICIIIIMMIMMHIIIHMIHIIMIMIMMHIMMILIHIIM"
TYPES = """
LOGIN_SUCCESS LOGIN_FAILURE LOGIN_SUCCESS LOGOUT UNAUTHORIZED_ACCESS DATA_MODIFICATION MFA_CHALLENGE LOGIN_SUCCESS
LOGIN_SUCCESS LOGIN_FAILURE ACCOUNT_LOCKOUT DATA_ACCESS UNAUTHORIZED_ACCESS UNAUTHORIZED_ACCESS ACCOUNT_LOCKOUT
LOGIN_FAILURE LOGIN_SUCCESS LOGIN_FAILURE DATA_ACCESS PRIVILEGE_ESCALATION DATA_ACCESS LOGIN_SUCCESS LOGIN_SUCCESS
LOGIN_SUCCESS LOGIN_FAILURE LOGIN_FAILURE LOGIN_SUCCESS PERMISSION_CHANGE LOGIN_FAILURE ACCOUNT_LOCKOUT LOGOUT LOGOUT
LOGIN_SUCCESS ACCOUNT_LOCKOUT UNAUTHORIZED_ACCESS LOGIN_SUCCESS LOGIN_FAILURE LOGIN_SUCCESS LOGIN_SUCCESS
PASSWORD_CHANGE LOGOUT LOGIN_FAILURE LOGIN_SUCCESS LOGIN_FAILURE LOGIN_FAILURE PRIVILEGE_ESCALATION LOGOUT
CONFIG_CHANGE DATA_MODIFICATION LOGIN_SUCCESS MFA_CHALLENGE LOGIN_SUCCESS UNAUTHORIZED_ACCESS LOGOUT LOGIN_SUCCESS
PASSWORD_CHANGE""".split()
SAMPLED_OUT = [16, 18, 21, 22, 24, 25, 27, 28, 30, 31, 34, 37, 39, 40, 42, 43]
# Countries of the accepted events, in order.
COUNTRIES = ["Mauritius"] * 2 + ["Laos", "Kuwait"] + ["Laos"] * 3 + ["Rwanda", "Philippines", "Rwanda", "Laos"] \
    + ["Rwanda"] * 2 + ["Laos"] * 2 + ["Rwanda"] + ["Philippines"] * 2 + ["Laos", "Barbados", "Hungary", "Rwanda"] \
    + ["Vietnam"] * 2 + ["Christmas Island", "Guyana"] + ["Lebanon"] * 2 + ["Philippines", "Barbados"]


@pytest.fixture(scope="module")
def run(spark):
    data = [(i, t, SEVERITY[s], 1) for i, (t, s) in enumerate(zip(TYPES, SEVERITIES, strict=True))]
    return spark.createDataFrame(data, "arrival_seq long, event_type string, severity string, w int")


@pytest.fixture(scope="module")
def accepted(spark, run):
    kept = sampling.priority_sample(run, ["w"], 30)
    geo = spark.createDataFrame(list(enumerate(COUNTRIES, 1)), "accepted long, c string")
    return (kept.join(geo, "accepted").withColumn("geo_location", F.struct(F.col("c").alias("country"))))


def test_sampler_accepts_the_recorded_events(run):
    kept = [r.arrival_seq for r in sampling.priority_sample(run, ["w"], 30).orderBy("arrival_seq").collect()]
    assert kept == [i for i in range(46) if i not in SAMPLED_OUT]


def test_rate_limit_alone(run):
    kept = [r.arrival_seq for r in sampling.rate_limit(run, ["w"], 30).orderBy("arrival_seq").collect()]
    assert kept == list(range(30))


def test_statistics_of_the_accepted_events(accepted):
    got = {(r.dimension, r.key): r.n for r in stats.distributions(accepted).collect()}
    assert got == {
        ("event_type", "LOGIN_SUCCESS"): 9, ("event_type", "LOGIN_FAILURE"): 7, ("event_type", "ACCOUNT_LOCKOUT"): 4,
        ("event_type", "UNAUTHORIZED_ACCESS"): 3, ("event_type", "DATA_ACCESS"): 2,
        ("event_type", "PRIVILEGE_ESCALATION"): 2, ("event_type", "LOGOUT"): 1, ("event_type", "DATA_MODIFICATION"): 1,
        ("event_type", "MFA_CHALLENGE"): 1,
        ("severity", "INFO"): 12, ("severity", "HIGH"): 10, ("severity", "MEDIUM"): 6, ("severity", "CRITICAL"): 2,
        ("country", "Mauritius"): 2, ("country", "Laos"): 8, ("country", "Kuwait"): 1, ("country", "Rwanda"): 6,
        ("country", "Philippines"): 4, ("country", "Barbados"): 2, ("country", "Hungary"): 1, ("country", "Vietnam"): 2,
        ("country", "Christmas Island"): 1, ("country", "Guyana"): 1, ("country", "Lebanon"): 2,
        ("total", "total"): 30}


def test_statistics_document_round_trip(accepted):
    long_form = stats.distributions(accepted)
    assert rows(stats.read_stats_document(stats.stats_document(long_form))) == rows(long_form)


def test_true_severity_distribution(run):
    r = stats.severity_pivot(run).first()
    assert (r["info"], r["low"], r["medium"], r["high"], r["critical"]) == (26, 1, 16, 11, 2)


def test_top_event_types(run):
    top = [(r.event_type, r.n) for r in stats.top_event_types(run).collect()]
    assert top == [("LOGIN_SUCCESS", 17), ("LOGIN_FAILURE", 11), ("LOGOUT", 6)]


def test_throughput_and_success_of_the_run(spark, run):
    assert stats.success_rate(run, F.lit(True)).first()["success_pct"] == 100.0
    half_way = run.limit(50)
    assert stats.success_rate(half_way, F.col("arrival_seq") < 49).first()["success_pct"] == 98.0
    timed = spark.sql("SELECT timestamp'2025-04-13 00:00:00' AS ts UNION ALL SELECT timestamp'2025-04-13 00:00:49.19'")
    assert stats.throughput(timed).first()["seconds"] == 49.19
