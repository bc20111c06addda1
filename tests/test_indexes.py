"""The kept sorted view and the index of seen ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_of
from vigilog.operators import rank_index, views
from vigilog.sinks import batches, seen_index, snapshots
from vigilog.sinks.seen_index import SeenIndex

EVENTS = "event_id string, arrival_seq long, ts timestamp, severity string, event_type string"


@pytest.fixture(scope="module")
def log(spark):
    """Five hundred events, a third of them with one severity, some without time or type."""
    severities = ["HIGH", "LOW", "INFO", "HIGH", "CRITICAL", "odd"]
    data = [(f"e{i}", (i * 37) % 500, None if i % 50 == 0 else i * 1000, severities[i % 6], None if i % 9 == 0 else f"t{i % 4}")
            for i in range(500)]
    raw = spark.createDataFrame(data, "event_id string, arrival_seq long, s long, severity string, event_type string")
    return raw.select("event_id", "arrival_seq", F.timestamp_seconds("s").alias("ts"), "severity", "event_type").cache()


@pytest.mark.parametrize("field,ascending", [("Severity", False), ("Time", False), ("Time", True), ("Type", True)])
def test_every_page_of_a_kept_view(spark, log, tmp_path, field, ascending):
    view = rank_index.build(log, str(tmp_path), field, ascending, ranges=7)
    want = [r.event_id for r in views.sort_events(log, field, ascending).collect()]
    for number in (1, 2, 5, 12, 13, 14, 40):
        got = sorted((r.pos, r.event_id) for r in view.page(number, 40).collect())
        assert [e for _, e in got] == want[(number - 1) * 40:number * 40]
        assert [p for p, _ in got] == list(range((number - 1) * 40 + 1, (number - 1) * 40 + 1 + len(got)))
    assert [r.event_id for r in view.between(1, 500).orderBy("pos").collect()] == want
    assert view.page_info(13, 40).first() == views.page_info(log, 13, 40).first()
    again = rank_index.load(spark, str(tmp_path), field, ascending)
    assert again.page(3, 40).count() == 40


def test_a_page_reads_the_ranges_it_lies_in_and_sorts_nothing(spark, log, tmp_path):
    view = rank_index.build(log, str(tmp_path), "Severity", ranges=9)
    page = view.page(7, 30)
    plan = plan_of(page)
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan
    assert 1 <= len(page.inputFiles()) and "PartitionFilters: [isnotnull(_part" in plan or "_part#" in plan
    files = page.select(F.input_file_name()).distinct().count()
    assert files <= 2


def test_keys_are_found_by_the_index(spark, log, tmp_path):
    down = rank_index.build(log, str(tmp_path / "a"), "Severity", ranges=5)
    ranks = [r.k for r in views.sort_events(log, "Severity").select(views.sort_key("Severity").alias("k")).collect()]
    for key in (6, 5, 4, 3, 2, 1, 0, -1):
        assert down.place_of(key) == next((i + 1 for i, k in enumerate(ranks) if k <= key), 501)
    assert down.page_of(2, 50) == (down.place_of(2) - 1) // 50 + 1
    up = rank_index.build(log, str(tmp_path / "b"), "Type", True, ranges=5)
    types = [r.k for r in views.sort_events(log, "Type", True).select(views.sort_key("Type").alias("k")).collect()]
    for key in ("", "t0", "t1", "t15", "t3", "u"):
        assert up.place_of(key) == next((i + 1 for i, k in enumerate(types) if k >= key), 501)
    time = rank_index.build(log, str(tmp_path / "c"), "Time", ranges=5)
    times = [r.ts for r in views.sort_events(log, "Time").collect()]
    for key in (times[0], times[100], times[480]):
        assert time.place_of(key) == next(i + 1 for i, t in enumerate(times) if t is None or t <= key)


def test_an_empty_view(log, tmp_path):
    view = rank_index.build(log.limit(0), str(tmp_path), "Severity")
    assert view.page(1).count() == 0 and view.page_info(1).first()["total"] == 0 and view.place_of(3) == 1


def test_filters_hold_their_ids_and_few_others():
    rng = np.random.default_rng(1)
    h1, h2, o1, o2 = (rng.integers(-2**63, 2**63 - 1, 20_000) for _ in range(4))
    made = seen_index.make_filter(3, h1, h2).to_pylist()[0]
    assert made["bucket"] == 3 and len(made["bits"]) * 8 == made["width"] == 400_000
    assert seen_index.may_hold(h1, h2, made["width"], made["bits"]).all()
    assert seen_index.may_hold(o1, o2, made["width"], made["bits"]).mean() < 0.001


def ids(spark, numbers):
    return spark.createDataFrame([(None if n is None else f"id-{n}", i) for i, n in enumerate(numbers)], "event_id string, arrival_seq long")


@pytest.mark.parametrize("bits", [20, 1])
def test_seen_ids_are_dropped_exactly(spark, tmp_path, bits):
    """With one bit per id most filters let unseen ids through, and the buckets tell."""
    index = SeenIndex(spark, str(tmp_path), buckets=8, bits=bits, most_ids=20)
    assert index.drop_seen(ids(spark, [1, 2, None])).count() == 3
    index.add(ids(spark, [*range(0, 100, 2), None, 4]), "event_id", 0)
    index.add(ids(spark, range(1, 60, 2)), "event_id", 1)
    asked = ids(spark, [*range(50, 150), 50, 51, None])
    got = sorted(r.event_id or "" for r in index.drop_seen(asked).collect())
    seen = set(range(0, 100, 2)) | set(range(1, 60, 2))
    assert got == sorted([""] + [f"id-{n}" for n in range(50, 150) if n not in seen])
    assert index.drop_seen(ids(spark, [1, 3]), before=1).count() == 2


def test_only_buckets_in_question_are_read_and_history_is_not_shuffled(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path), buckets=64)
    index.add(ids(spark, range(4000)), "event_id", 0)
    asked = ids(spark, [7, 9, *range(10_000, 10_200)])
    seen = index.seen(asked, "event_id")
    assert sorted(r.id for r in seen.collect()) == ["id-7", "id-9"]
    plan = plan_of(seen)
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    possible = index.possible(seen_index._keys(asked, "event_id", 64), index.versions()).select("bucket").distinct().count()
    assert possible <= 4


def test_compaction_keeps_all_ids_and_few_versions(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path), buckets=2)
    for batch in range(17):
        index.add(ids(spark, [batch, batch + 100]), "event_id", batch)
        index.compact(batch)
    assert index.versions() == [(1, 0), (1, 1), (0, 16)]
    assert snapshots.committed_versions(spark, f"{tmp_path}/level=0/filters") == [16]
    assert index.drop_seen(ids(spark, [*range(17), *range(100, 117), 50])).count() == 1
    assert index.drop_seen(ids(spark, [16]), before=16).count() == 1
    index.compact(17)
    assert index.drop_seen(ids(spark, [*range(17), 50])).count() == 1


def test_first_arrivals_over_all_batches(spark, tmp_path):
    out, index = str(tmp_path / "out"), str(tmp_path / "seen")
    got = []
    step = batches.unseen(out, index, buckets=4, then=lambda df, batch_id: got.append((batch_id, df.count())))
    for batch_id, numbers in enumerate([[1, 2, 2, 3], [3, 4], [], [1, 5, None, None, 4]]):
        step(ids(spark, numbers), batch_id)
        step(ids(spark, numbers), batch_id)  # a retry
    kept = sorted(r.event_id or "" for r in spark.read.parquet(out).collect())
    assert kept == ["", "", "id-1", "id-2", "id-3", "id-4", "id-5"]
    assert got == [(0, 3), (0, 3), (1, 1), (1, 1), (2, 0), (2, 0), (3, 3), (3, 3)]
