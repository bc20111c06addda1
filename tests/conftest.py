import json

import pytest

from vigilog.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows of a frame as a sorted list of tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def record(i, event_type="LOGIN_SUCCESS", severity="INFO", **more):
    """A full wire record as a dict."""
    event = {
        "event_id": f"id-{i}", "timestamp": f"2025-04-13T21:{i // 60 % 60:02d}:{i % 60:02d}.000001Z",
        "event_type": event_type, "user_id": f"user_{i % 5}", "user_type": "EMPLOYEE", "ip_address": f"10.0.0.{i % 250}",
        "geo_location": {"country": "Rwanda", "city": "Kigali", "latitude": 1.5, "longitude": 2.5},
        "user_agent": "agent", "status_code": 200, "message": "text", "correlation_id": f"c{i // 4}",
        "session_id": f"sess_{i % 3}", "severity": severity, "source_system": "web-portal",
        "target_system": "auth-service", "tags": ["authentication", "employee"], "additional_info": {"n": i}}
    event.update(more)
    return event


def as_values(spark, records):
    """Records (dicts or raw text) as the ``value`` column of a topic, with their arrival number."""
    data = [(i, bytearray((r if isinstance(r, str) else json.dumps(r)).encode())) for i, r in enumerate(records)]
    return spark.createDataFrame(data, "arrival_seq long, value binary")
