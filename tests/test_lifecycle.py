"""Keyed session state, the stream lookup and the rolling timeline against their batch forms."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import record, rows
from tests.test_streams import batch, drain, stream, write_lines
from vigilog.operators import sessions, stats
from vigilog.plans import streams
from vigilog.streaming import ingest, lifecycle, timeline

HOUR = 3_600_000_000


def at(i, clock, kind="DATA_ACCESS", session=None):
    return record(i, kind, timestamp=f"2025-04-{clock}Z", session_id=session, arrival=i)


def test_fold_does_not_depend_on_the_cut():
    """Any events folded at once or one by one give the same session."""
    for seed in range(300):
        r = random.Random(seed)
        raw = [(r.randrange(12) * HOUR, 1, r.random() < 0.3, r.random() < 0.3) for _ in range(r.randrange(1, 9))]
        events = lifecycle.combine(raw)
        assert sum(e[1] for e in events) == len(raw)
        whole = lifecycle.fold(None, events, 4 * HOUR)
        step = None
        for event in events:
            step = lifecycle.fold(step, [event], 4 * HOUR)
        assert whole == step
        first = events[0][0]
        login = next((e[0] for e in events if e[2] and e[0] <= first + 4 * HOUR), None)
        limit = (first if login is None else login) + 4 * HOUR
        out = next((e[0] for e in events if e[3] and login is not None and login <= e[0] <= limit), None)
        end = limit if out is None else out
        assert (whole.first, whole.created, whole.ended, whole.end(4 * HOUR)) == (first, login, out, end)
        assert whole.events == sum(e[1] for e in events if e[0] <= end)


@pytest.fixture()
def log(tmp_path):
    """Sessions that close, expire, never open, come late or go on after their end, in six files; the last ones move the clock."""
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [at(0, "13T01:00:00", "LOGIN_SUCCESS", "closed"), at(1, "13T01:00:00", "LOGIN_SUCCESS", "old"),
                                   at(2, "13T01:30:00", session="stray"), at(3, "13T01:10:00", session="closed"),
                                   at(4, "13T01:31:00", session="late")])
    write_lines(folder, "b.json", [at(5, "13T01:40:00", "LOGOUT", "closed"), at(6, "13T01:36:00", "LOGIN_SUCCESS", "late"),
                                   at(7, "13T01:38:00", session=None), at(8, "13T01:42:00", "LOGOUT", "stray")])
    write_lines(folder, "c.json", [at(9, "13T01:37:00", session="closed"), at(10, "13T01:45:00", session="closed"),
                                   at(11, "13T01:41:00", "LOGOUT", "late"), at(12, "13T02:10:00", session="old")])
    write_lines(folder, "d.json", [at(13, "13T03:00:00", session="closed"), at(14, "13T08:59:00", session="old"),
                                   at(15, "13T09:05:00", "LOGOUT", "old"), at(16, "13T09:20:00", session="stray")])
    write_lines(folder, "e.json", [at(17, "15T12:00:00", session=None)])
    write_lines(folder, "f.json", [at(18, "18T12:00:00", session=None)])
    return folder


WANTED = {"closed": ("closed", 4), "old": ("expired", 3), "stray": ("unopened", 3), "late": ("closed", 3)}


def test_one_row_per_session_whatever_comes_after_its_end(spark, log, tmp_path):
    got = drain(lifecycle.session_rows(stream(spark, log)), tmp_path)
    assert {r.session_id: (r.state, r.events) for r in got.collect()} == WANTED
    assert got.count() == 4
    assert got.select("batch_id").distinct().count() > 1
    columns = ["session_id", "created_at", "ended_at", "first_seen", "last_seen", "events", "ends_at", "state"]
    assert rows(got.select(*columns)) == rows(sessions.lifecycle(batch(spark, log)).select(*columns))


def test_state_is_forgotten(spark, log, tmp_path):
    """After the time it is remembered a session leaves the state."""
    query = ingest.run_stream(lifecycle.session_rows(stream(spark, log), remember="1 hour"),
                              lambda df, batch_id: df.collect(), str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_a_restart_goes_on_with_the_state(spark, log, tmp_path):
    out = tmp_path / "out"
    later = log.parent / "later"
    later.mkdir()
    for name in ("d.json", "e.json", "f.json"):
        (log / name).rename(later / name)
    drain(lifecycle.session_rows(stream(spark, log)), tmp_path)
    for name in ("d.json", "e.json", "f.json"):
        (later / name).rename(log / name)
    got = drain(lifecycle.session_rows(stream(spark, log)), tmp_path)
    assert {r.session_id: (r.state, r.events) for r in got.collect()} == WANTED and got.count() == 4
    assert out.exists()


def test_stream_lookup_equals_batch(spark, log, tmp_path):
    found = lifecycle.live_lookup(stream(spark, log), lifecycle.session_rows(stream(spark, log)))
    got = drain(found, tmp_path).filter("ts < TIMESTAMP '2025-04-14 00:00:00'")
    events = batch(spark, log).filter("ts < TIMESTAMP '2025-04-14 00:00:00'")
    table = sessions.lifecycle(events)
    ended = table.withColumn("expires_at", F.col("ends_at"))
    want = sessions.session_lookup(events, ended)
    columns = ["arrival_seq", "session_id", "live", "session_start"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))
    assert got.filter("live").count() == 4 + 3 + 2


def test_stateful_lookup_bounds_its_state(spark, log, tmp_path):
    found = lifecycle.live_lookup(stream(spark, log), lifecycle.session_rows(stream(spark, log)))
    query = ingest.run_stream(found, lambda df, batch_id: df.collect(), str(tmp_path / "cp"))
    query.awaitTermination()
    join = [s for s in query.recentProgress[-1]["stateOperators"] if s["operatorName"] == "symmetricHashJoin"][0]
    assert join["numRowsTotal"] <= 1


def test_timeline_equals_batch_and_only_it_drops_late_rows(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "ring")
    for part in range(5):
        lines = [at(part * 20 + i, f"13T{10 + part // 2:02d}:{(part * 20 + i) % 60:02d}:{i:02d}.{i:03d}",
                    ["DATA_ACCESS", "LOGOUT"][i % 2]) for i in range(20)]
        write_lines(folder, f"{part}.json", lines)
    write_lines(folder, "late.json", [at(900, "13T10:00:00"), at(901, "13T12:39:00"), record(902, timestamp="bad", arrival=902)])
    source = stream(spark, folder).filter("event_id <> 'id-902'")
    step = timeline.rolling(out)

    def twice(df, batch_id):
        step(df, batch_id)
        step(df, batch_id)
    ingest.run_stream(source, twice, str(tmp_path / "cp")).awaitTermination()
    events = batch(spark, folder)
    for as_of in (None, F.lit("2025-04-13T12:45:10Z").cast("timestamp"), F.lit("2025-04-13T14:00:00Z").cast("timestamp")):
        clock = F.ceil(F.unix_micros(F.lit("2025-04-13T12:39:19.019Z").cast("timestamp")) / 1_000_000)
        want = stats.activity_timeline(events, as_of=F.timestamp_seconds(clock) if as_of is None else as_of)
        assert rows(timeline.timeline(spark, out, as_of)) == rows(want)
    ring = spark.read.parquet(timeline.snapshots.latest_version(spark, out))
    assert ring.agg(F.sum("total")).first()[0] == 102
    assert ring.filter("second < TIMESTAMP '2025-04-13 12:09:00'").count() == 0


def test_timeline_needs_more_than_five_events(spark, tmp_path):
    out = str(tmp_path / "ring")
    assert timeline.timeline(spark, out).count() == 0
    step = timeline.rolling(out)
    events = spark.createDataFrame([(f"2025-04-13 10:00:0{i}", "A") for i in range(6)], "t string, event_type string").select(
        F.col("t").cast("timestamp").alias("ts"), "event_type")
    step(events.limit(5), 0)
    assert timeline.timeline(spark, out).count() == 0
    step(events.limit(1), 1)
    assert timeline.timeline(spark, out).agg(F.sum("n")).first()[0] == 6


def test_state_has_a_row_per_bucket_not_per_session(spark, tmp_path):
    """Any number of sessions in four buckets is four values of state and four timers."""
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [at(i, f"13T01:{i % 60:02d}:00", ["LOGIN_SUCCESS", "LOGOUT"][i // 100], f"s{i % 100}") for i in range(200)])
    write_lines(folder, "b.json", [at(200, "15T12:00:00", session=None)])
    sizes = []

    def on_batch(df, batch_id):
        sizes.append(df.count())
    query = ingest.run_stream(lifecycle.session_rows(stream(spark, folder), buckets=4), on_batch, str(tmp_path / "cp"))
    query.awaitTermination()
    assert sum(sizes) == 100
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4 * 4  # timers have two indexes


def test_files_of_the_log_follow_in_time_whatever_the_ids(spark, tmp_path):
    ids = spark.range(200).select(
        (F.col("id") * 7 % 200).alias("event_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    ids.write.parquet(str(tmp_path / "sf" / "events.parquet"))
    path = streams.in_files(spark, str(tmp_path / "sf"), by="ts")
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("*").alias("n"),
        F.min("_metadata.file_modification_time").alias("written")).orderBy("written").collect()
    assert len(spans) == streams.BATCHES and sum(s.n for s in spans) == 200
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))


def test_costly_work_per_row_is_spread_over_tasks(spark, sf_dir, tmp_path):
    """The event table is one row group, which one task would read and parse."""
    parts = []
    for spread in (False, True):
        events = streams.stream_events(spark, sf_dir, spread=spread)
        ingest.run_stream(events, lambda df, batch_id: parts.append((df.rdd.getNumPartitions(), df.count())),
                          str(tmp_path / f"cp{spread}")).awaitTermination()
    assert parts[0] == (1, parts[1][1]) and parts[1][0] > 1
