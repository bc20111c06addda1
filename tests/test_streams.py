"""Streaming forms against their batch forms, over several micro-batches."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import record, rows
from tests.test_golden import SAMPLED_OUT, SEVERITY
from tests.test_golden import SEVERITIES as SEVERITIES_56
from tests.test_golden import TYPES as TYPES_56
from vigilog.operators import parsing, sampling, sessions, stats, views
from vigilog.sinks import batches, snapshots
from vigilog.sinks import kafka as kafka_sink
from vigilog.sources import files
from vigilog.streaming import ingest, progress

TYPES = ["LOGIN_SUCCESS", "LOGIN_FAILURE", "DATA_ACCESS", "LOGOUT", "ACCOUNT_LOCKOUT"]
SEVERITIES = ["INFO", "MEDIUM", "HIGH", "LOW", "CRITICAL", "INFO", "INFO"]


def make_records(n):
    return [record(i, TYPES[i % 5], SEVERITIES[i % 7], geo_location=None if i % 6 == 0 else {"country": f"c{i % 4}"},
                   source_system=None, arrival=i) for i in range(n)]


WRITTEN = itertools.count(1700000000)


def write_lines(folder, name, records):
    """Write a file that is a second newer than the one before: a file stream takes them by age, ties in any order."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    os.utime(folder / name, (next(WRITTEN),) * 2)


@pytest.fixture()
def inbox(tmp_path):
    """Sixty records in four files, among them broken lines and repeats."""
    records = make_records(60)
    for part in range(4):
        lines = records[part * 15:part * 15 + 15] + ["{broken", "null"]
        if part:
            lines.append({**records[part * 15 - 1], "severity": "CRITICAL"})
        write_lines(tmp_path / "in", f"part-{part}.json", lines)
    return tmp_path / "in"


def stream(spark, inbox):
    source = files.stream_json(spark, str(inbox), files_per_trigger=1)
    e = ingest.accepted_events(source)
    return e.withColumn("arrival_seq", F.get_json_object("raw", "$.arrival").cast("long"))


def batch(spark, inbox):
    e = parsing.with_time(parsing.fill_defaults(parsing.good_records(parsing.parse_value(spark.read.text(str(inbox))))))
    return e.withColumn("arrival_seq", F.get_json_object("raw", "$.arrival").cast("long"))


def drain(df, tmp_path, name="out", mode="append"):
    out = str(tmp_path / name)
    query = ingest.run_stream(df, batches.changed_rows(out), str(tmp_path / f"{name}-cp"), mode)
    query.awaitTermination()
    return df.sparkSession.read.parquet(out)


def test_micro_batches_and_dead_letters(spark, inbox, tmp_path):
    parsed = parsing.parse_value(files.stream_json(spark, str(inbox), files_per_trigger=1))
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    ingest.run_stream(parsed, batches.good_and_dead(good, dead), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(good).count() == 63
    assert sorted(r.raw for r in spark.read.parquet(dead).collect()) == ["null"] * 4 + ["{broken"] * 4
    assert spark.read.parquet(good).select("batch_id").distinct().count() == 4


@pytest.mark.parametrize("salts", [1, 4])
def test_dedup_equals_batch(spark, inbox, tmp_path, salts):
    got = drain(ingest.dedup(stream(spark, inbox), salts=salts), tmp_path)
    assert sorted(r.event_id for r in got.collect()) == sorted(f"id-{i}" for i in range(60))


def test_minute_counts_equal_batch(spark, inbox, tmp_path):
    log = drain(ingest.minute_counts(stream(spark, inbox), "1 day"), tmp_path, mode="update")
    got = batches.latest_rows(log, ["minute", "event_type"])
    assert rows(got) == rows(stats.events_per_minute(batch(spark, inbox)))


def test_an_event_without_time_takes_its_arrival(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [record(0, timestamp=None), record(1, timestamp="bad"), record(2)])
    source = files.stream_json(spark, str(tmp_path / "in"))
    ids = {r.event_id: r.ts.year for r in drain(ingest.accepted_events(source), tmp_path).collect()}
    assert set(ids) == {"id-0", "id-1", "id-2"} and ids["id-2"] == 2025 and min(ids["id-0"], ids["id-1"]) > 2025
    stamped = source.withColumn("received_at", F.lit("2024-02-03T04:05:06Z").cast("timestamp"))
    ids = {r.event_id: r.ts.year for r in drain(ingest.accepted_events(stamped), tmp_path, "b").collect()}
    assert ids == {"id-0": 2024, "id-1": 2024, "id-2": 2025}


def test_the_consumer_takes_every_readable_record(spark, tmp_path):
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [record(0), record(1, timestamp="2099-01-01T00:00:00Z"), record(2, event_id=None), record(3, event_type=None)])
    write_lines(folder, "b.json", [record(4, event_type="EventType.LOGOUT"), record(5, geo_location={}), record(6, timestamp="bad")])
    write_lines(folder, "c.json", [record(7, message=None), record(8, timestamp="2025-03-01T00:00:00Z"), record(0, severity="LOW"), "{broken"])
    source = files.stream_json(spark, str(folder)).withColumn("arrival_seq", F.crc32("value"))
    ingest.consume(source, str(tmp_path / "out"), str(tmp_path / "check"), budget=100).awaitTermination()
    totals = {r.key: r.n for r in files.load_stats(spark, str(tmp_path / "out/stats")).filter("dimension = 'total'").collect()}
    assert totals == {"total": 9}
    dead = spark.read.parquet(str(tmp_path / "out/dead"))
    assert [(r.raw, r.reason) for r in dead.collect()] == [("{broken", "unreadable record")]
    invalid = spark.read.parquet(str(tmp_path / "out/invalid"))
    assert sorted(tuple(r.violations) for r in invalid.collect()) == [
        ("bad_timestamp",), ("missing_country",), ("missing_event_id",), ("missing_event_type",), ("missing_message",)]


def test_late_rows_count_in_totals_but_not_in_the_timeline(spark, tmp_path):
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [record(i) for i in range(10)])
    write_lines(folder, "b.json", [record(11, timestamp="2025-04-13T23:59:00Z")])
    write_lines(folder, "c.json", [record(12, timestamp="2025-04-13T20:00:00Z")])
    counts = drain(ingest.minute_counts(stream(spark, folder), "30 minutes"), tmp_path, "t", "update")
    minutes = {r.minute.hour for r in counts.collect()}
    assert 20 not in minutes and 23 in minutes
    totals = batches.latest_rows(drain(ingest.running_totals(stream(spark, folder)), tmp_path, "r", "update"),
                                 ["dimension", "key"])
    assert {r.key: r.n for r in totals.filter("dimension = 'total'").collect()} == {"total": 12}


def test_running_totals_equal_batch(spark, inbox, tmp_path):
    log = drain(ingest.running_totals(stream(spark, inbox)), tmp_path, mode="update")
    got = batches.latest_rows(log, ["dimension", "key"]).filter("n > 0")
    assert rows(got) == rows(stats.distributions(batch(spark, inbox)))


@pytest.mark.parametrize("on", [True, False])
def test_sampler_equals_batch(spark, inbox, tmp_path, on):
    def keyed(df):
        return df.withColumn("w", F.col("arrival_seq") >= 40).select("w", "arrival_seq", "severity", "event_id")
    # Without the repeats, whose arrival numbers are not unique.
    clean = stream(spark, inbox).filter("NOT (severity = 'CRITICAL' AND arrival_seq % 15 = 14)")
    static = batch(spark, inbox).filter("NOT (severity = 'CRITICAL' AND arrival_seq % 15 = 14)")
    out = str(tmp_path / "out")
    step = batches.sampled(f"{out}/accepted", f"{out}/state", ["w"], 10, on)

    def twice(df, batch_id):
        step(df, batch_id)
        step(df, batch_id)
    ingest.run_stream(keyed(clean), twice, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(f"{out}/accepted")
    assert got.select("batch_id").distinct().count() > 1
    want = (sampling.priority_sample if on else sampling.rate_limit)(keyed(static), ["w"], 10)
    columns = ["arrival_seq", "event_id", "place"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_windows_without_events_leave_the_sampler(spark, tmp_path):
    step = batches.sampled(str(tmp_path / "out"), str(tmp_path / "state"), ["w"], budget=2, forget_after=2)
    rows_of = spark.createDataFrame([(i, i // 4, "INFO", f"e{i}") for i in range(24)], "arrival_seq long, w long, severity string, event_id string")
    for batch_id in range(6):
        step(rows_of.filter(F.col("w") == batch_id), batch_id)
        state = spark.read.parquet(snapshots.latest_version(spark, str(tmp_path / "state")))
        assert sorted(r.w for r in state.collect()) == list(range(max(0, batch_id - 1), batch_id + 1))


@pytest.mark.parametrize("keys", [["w"], ["shard", "w"]])
def test_a_closed_window_never_gets_a_second_budget(spark, tmp_path, keys):
    """Sixty events of one window around a batch without any of it: 30 at most are accepted, before and after."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    step = batches.sampled(out, state, keys, budget=30, sampling=False, forget_after=1)

    def events(w, first, n, shard="a"):
        return [(first + i, w, shard, "HIGH", f"e{first + i}") for i in range(n)]
    parts = [events(5, 0, 20), events(5, 20, 20), events(6, 40, 5), events(5, 45, 20) + events(7, 65, 3) + events(5, 70, 4, "b"), []]
    for batch_id, part in enumerate(parts):
        df = spark.createDataFrame(part, "arrival_seq long, w long, shard string, severity string, event_id string")
        for _ in range(2):
            step(df, batch_id)
    got = {(r.shard, r.w): r.n for r in spark.read.parquet(out).groupBy("shard", "w").agg(F.count(F.lit(1)).alias("n")).collect()}
    other = {("b", 5): 4} if len(keys) == 2 else {}
    assert got == {("a", 5): 30, ("a", 6): 5, ("a", 7): 3, **other}
    assert spark.read.parquet(snapshots.latest_version(spark, f"{state}_closed")).count() == len(keys)


def test_state_of_the_sampler_stays_small(spark, tmp_path):
    step = batches.sampled(str(tmp_path / "out"), str(tmp_path / "state"), ["w"], budget=2, forget_after=2)
    sizes = []
    for batch_id in range(12):
        step(spark.createDataFrame([(batch_id * 4 + i, batch_id, "INFO", "e") for i in range(4)],
                                   "arrival_seq long, w long, severity string, event_id string"), batch_id)
        sizes.append(spark.read.parquet(snapshots.latest_version(spark, str(tmp_path / "state"))).count())
    assert max(sizes) <= 2


def test_whole_consumer_on_the_recorded_run(spark, tmp_path):
    """56 events in several batches, all within one window: 30 are accepted, retained and counted."""
    for part in range(0, 56, 12):
        lines = [record(i, t, SEVERITY[s], arrival=i) for i, (t, s) in enumerate(zip(TYPES_56, SEVERITIES_56))]
        write_lines(tmp_path / "in", f"{part:02d}.json", lines[part:part + 12] + ["{broken"])
    source = files.stream_json(spark, str(tmp_path / "in"), files_per_trigger=1)
    source = source.withColumn("arrival_seq", F.coalesce(F.get_json_object("value", "$.arrival").cast("long"), F.lit(-1)))
    out = str(tmp_path / "out")
    ingest.consume(source, out, str(tmp_path / "cp"), window_seconds=3600).awaitTermination()
    kept = [i for i in range(46) if i not in SAMPLED_OUT]
    accepted = spark.read.parquet(f"{out}/accepted")
    assert sorted(r.arrival_seq for r in accepted.collect()) == kept
    retained = spark.read.parquet(snapshots.latest_version(spark, f"{out}/retained"))
    assert sorted(r.arrival_seq for r in retained.collect()) == kept
    totals = {(r.dimension, r.key): r.n for r in files.load_stats(spark, f"{out}/stats").collect()}
    assert totals["total", "total"] == 30 and totals["severity", "HIGH"] == 10
    assert totals["event_type", "LOGIN_FAILURE"] == 7


def test_session_lifecycle(spark, tmp_path):
    def at(i, hour, kind, session):
        return record(i, kind, timestamp=f"2025-04-13T{hour:02d}:00:00Z", session_id=session)
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [at(0, 1, "LOGIN_SUCCESS", "closed"), at(1, 1, "LOGIN_SUCCESS", "old"),
                                   at(2, 2, "DATA_ACCESS", "stray"), at(3, 1, "DATA_ACCESS", "closed")])
    write_lines(folder, "b.json", [at(4, 2, "LOGOUT", "closed"), at(5, 3, "DATA_ACCESS", "old")])
    write_lines(folder, "c.json", [at(6, 22, "LOGIN_SUCCESS", "young")])
    out = str(tmp_path / "out")
    step = batches.session_log(f"{out}/ended", f"{out}/open")

    def twice(df, batch_id):
        step(df, batch_id)
        step(df, batch_id)
    ingest.run_stream(stream(spark, folder), twice, str(tmp_path / "cp")).awaitTermination()
    ended = spark.read.parquet(f"{out}/ended")
    assert {r.session_id: (r.state, r.events) for r in ended.collect()} == {
        "closed": ("closed", 3), "old": ("expired", 2), "stray": ("unopened", 1)}
    assert ended.count() == 3
    still_open = spark.read.parquet(snapshots.latest_version(spark, f"{out}/open")).filter("NOT over")
    assert [r.session_id for r in still_open.filter("session_id IS NOT NULL").collect()] == ["young"]
    final = sessions.session_state(sessions.session_summary(batch(spark, folder)),
                                   F.lit("2025-04-13T22:00:00Z").cast("timestamp"))
    assert {r.session_id: (r.state, r.events) for r in final.collect()} == {
        "closed": ("closed", 3), "old": ("expired", 2), "stray": ("unopened", 1), "young": ("active", 1)}


def test_a_session_that_goes_on_after_its_end_has_one_row(spark, tmp_path):
    out = str(tmp_path / "out")
    step = batches.session_log(f"{out}/ended", f"{out}/open")

    def events(*rows_):
        return spark.createDataFrame([(i, t, f"2024-01-0{d} {h:02d}:00:00") for i, t, d, h in rows_],
                                     "session_id string, event_type string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    parts = [events(("s", "LOGIN_SUCCESS", 1, 1), ("s", "LOGOUT", 1, 2)), events(("x", "DATA_ACCESS", 1, 5)),
             events(("s", "DATA_ACCESS", 1, 6)), events(("s", "DATA_ACCESS", 1, 7), ("x", "DATA_ACCESS", 1, 8)), events(("y", "LOGOUT", 1, 23))]
    for batch_id, part in enumerate(parts):
        for _ in range(2):
            step(part, batch_id)
    ended = [(r.session_id, r.state, r.events) for r in spark.read.parquet(f"{out}/ended").collect()]
    assert sorted(ended) == [("s", "closed", 2), ("x", "unopened", 2)]
    step(events(("z", "LOGOUT", 9, 1)), 5)
    kept = spark.read.parquet(snapshots.latest_version(spark, f"{out}/open")).filter("session_id IS NOT NULL")
    assert {r.session_id for r in kept.collect()} == {"y", "z"}


def test_gap_session_stream_equals_batch(spark, inbox, tmp_path):
    far = record(999, timestamp="2026-01-01T00:00:00Z", user_id="zz", arrival=999)
    write_lines(inbox, "part-9.json", [far])
    got = drain(ingest.gap_session_counts(stream(spark, inbox), "12 seconds"), tmp_path)
    want = sessions.gap_sessions(batch(spark, inbox).filter("user_id <> 'zz'"), 12)
    columns = ["user_id", "started_at", "ended_at", "events"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_restart_neither_loses_nor_repeats(spark, inbox, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        ingest.run_stream(ingest.dedup(stream(spark, inbox)), batches.changed_rows(out), cp).awaitTermination()
    run()
    write_lines(inbox, "part-5.json", [record(70, arrival=70), record(3, arrival=71)])
    run()
    ids = [r.event_id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted([f"id-{i}" for i in range(60)] + ["id-70"])


def test_a_retried_batch_changes_nothing(spark, inbox, tmp_path):
    e = batch(spark, inbox).select("event_id", "arrival_seq", "event_type", "severity", "geo_location")
    kept, counted = str(tmp_path / "kept"), str(tmp_path / "counted")
    steps = batches.persisted(batches.retained(kept, 20), batches.running_stats(counted))
    for batch_id, part in [(0, e.filter("arrival_seq < 30")), (1, e.filter("arrival_seq >= 30")),
                           (1, e.filter("arrival_seq >= 30"))]:
        steps(part, batch_id)
    assert rows(files.load_stats(spark, counted)) == rows(stats.distributions(e))
    last = spark.read.parquet(snapshots.latest_version(spark, kept))
    assert sorted(r.arrival_seq for r in last.collect()) == list(range(40, 60))


def test_retained_stream_equals_batch(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    e = ingest.dedup(stream(spark, inbox)).select("event_id", "arrival_seq", "severity")
    ingest.run_stream(e, batches.retained(out, 25, fmt="json"), str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.schema(e.schema).json(snapshots.latest_version(spark, out))
    assert sorted(r.arrival_seq for r in kept.collect()) == list(range(35, 60))
    assert len(snapshots.committed_versions(spark, out)) == 2
    want = views.retain_last(batch(spark, inbox).dropDuplicates(["event_id"]), 25)
    assert rows(kept.select("event_id")) == rows(want.select("event_id"))


def test_observed_metrics_reach_the_listener(spark, inbox, tmp_path):
    lines = []
    listener = progress.ProgressLog(report=lines.append, every=20)
    spark.streams.addListener(listener)
    try:
        drain(progress.observed(stream(spark, inbox)), tmp_path)
        for _ in range(100):
            if listener.events == 63:
                break
            import time
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.events == 63 and listener.batches == 4
    assert len(lines) == 3 and lines[-1].startswith("63 events")
    events = batch(spark, inbox)
    for dimension in ("event_type", "severity"):
        want = {(dimension, r[0]): r[1] for r in events.groupBy(dimension).count().collect()}
        assert {k: n for k, n in listener.counts.items() if k[0] == dimension} == want
    assert listener.top("event_type", 1).split()[0] in TYPES


def test_processing_time_trigger(spark, inbox, tmp_path):
    query = ingest.run_stream(stream(spark, inbox), batches.changed_rows(str(tmp_path / "o")), str(tmp_path / "cp"),
                              interval="2 seconds")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "o")).count() == 63
    finally:
        query.stop()


def test_kafka_sink_options():
    o = kafka_sink.sink_options("h:9092", "t")
    assert (o["kafka.acks"], o["kafka.retries"], o["kafka.retry.backoff.ms"]) == ("all", "5", "500")


def test_folders_and_single_files_stream_alike(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "table.parquet"))
    spark.range(10, 30).repartition(3).write.mode("append").parquet(str(tmp_path / "table.parquet"))
    single = next((tmp_path / "table.parquet").glob("*.parquet"))
    schema = spark.range(1).schema
    folder = files.stream_table(spark, str(tmp_path / "table.parquet"), schema, files_per_trigger=2)
    assert drain(folder, tmp_path, "a").count() == 30
    n = spark.read.parquet(str(single)).count()
    assert drain(files.stream_table(spark, str(single), schema), tmp_path, "b").count() == n
