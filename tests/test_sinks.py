"""Files, snapshots and routed output."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_values, record, rows
from vigilog.operators import parsing, stats
from vigilog.sinks import batches, snapshots
from vigilog.sources import files


def events(spark, n=12):
    sev = ["INFO", "HIGH", "CRITICAL", "LOW"]
    return parsing.with_time(parsing.good_records(parsing.parse_value(
        as_values(spark, [record(i, severity=sev[i % 4]) for i in range(n)]))))


def test_array_file(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps([record(i) for i in range(3)]))
    scanned = files.scan_events(spark, str(tmp_path / "log.json"), array_file=True)
    assert sorted(r.event_id for r in scanned.collect()) == ["id-0", "id-1", "id-2"]
    assert scanned.first().additional_info in ('{"n": 0}', '{"n":0}')


def test_missing_file_is_empty(spark, tmp_path):
    assert files.scan_events(spark, str(tmp_path / "none.json")).count() == 0
    assert files.load_stats(spark, str(tmp_path / "none")).count() == 0
    assert files.load_stats_document(spark, str(tmp_path / "none")).count() == 0


def test_corrupt_file_is_set_apart(spark, tmp_path):
    (tmp_path / "log.json").write_text('[{"event_id": "a"}, {"event')
    scanned = files.scan_events(spark, str(tmp_path / "log.json"), array_file=True)
    files.quarantine(scanned, str(tmp_path / "bad"))
    kept = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [r.raw for r in kept] == ['[{"event_id": "a"}, {"event']
    assert parsing.good_records(scanned).collect() == []


def test_line_file_keeps_its_good_lines(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"event_id": "a"}\n{bad\n{"event_id": "b"}\n')
    scanned = files.scan_events(spark, str(tmp_path / "log.json"))
    assert sorted(r.event_id or "-" for r in scanned.collect()) == ["-", "a", "b"]


def test_scanned_records_without_id_get_a_stable_one(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"event_type": "LOGOUT"}\n{"event_type": "LOGIN_SUCCESS"}\n{bad\n')
    ids = [[r.event_id for r in parsing.fill_defaults(parsing.good_records(
        files.scan_events(spark, str(tmp_path / "log.json")))).collect()] for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 2


def test_corrupt_stats_document_counts_nothing(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"event_counts": {"A": 1')
    assert files.load_stats_document(spark, str(tmp_path / "s.json")).agg(F.sum("n")).first()[0] in (None, 0)


def test_stats_document_with_missing_maps(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"event_counts": {"A": 1}, "messages_received": 1}')
    assert rows(files.load_stats_document(spark, str(tmp_path / "s.json"))) == [
        ("event_type", "A", 1), ("total", "total", 1)]


def test_stats_documents_accumulate(spark, tmp_path):
    e, path = events(spark), str(tmp_path / "s")
    write = batches.stats_documents(path)
    for batch_id, part in [(0, e.filter("arrival_seq < 5")), (1, e.filter("arrival_seq >= 5")),
                           (1, e.filter("arrival_seq >= 5"))]:
        write(part, batch_id)
    got = files.load_stats_document(spark, snapshots.latest_version(spark, path))
    assert rows(got) == rows(stats.distributions(e))


def test_readers_only_see_committed_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(4):
        snapshots.write_version(spark.range(v + 1), path, v)
    (tmp_path / "t" / "version=9").mkdir()
    assert snapshots.committed_versions(spark, path) == [2, 3]
    assert spark.read.parquet(snapshots.latest_version(spark, path)).count() == 4
    assert snapshots.latest_version(spark, path, before=3).endswith("version=2")
    with pytest.raises(ValueError, match="reset it"):
        snapshots.write_version(spark.range(1), path, 0)
    snapshots.reset(spark, path)
    assert snapshots.latest_version(spark, path) is None
    snapshots.write_version(spark.range(1), path, 0)


def test_routed_output(spark, tmp_path):
    main, severe = str(tmp_path / "main"), str(tmp_path / "severe")
    for _ in range(2):
        batches.routed(main, severe)(events(spark), 0)
    assert spark.read.parquet(main).count() == 12
    assert {r.log_level for r in spark.read.parquet(severe).collect()} == {"ERROR", "CRITICAL"}
    assert spark.read.parquet(severe).count() == 6
    # The level is a partition column, so a filter on it prunes folders.
    plan = spark.read.parquet(main).filter("log_level = 'ERROR'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(log_level" in plan


def test_console(spark, capsys):
    batches.console(5)(events(spark, 3).select("event_id"), 7)
    shown = capsys.readouterr().out
    assert "batch 7 |" in shown and "3 records" in shown and "id-2" in shown
    batches.console(5)(events(spark, 3).filter("false"), 8)
    assert capsys.readouterr().out == ""


def test_statistics_documents_in_versions_and_corrupt_ones(spark, tmp_path):
    from vigilog.operators import stats
    path, backup = tmp_path / "stats", str(tmp_path / "backup")
    table = spark.createDataFrame([("severity", "LOW", 2), ("total", "total", 2)], "dimension string, key string, n long")
    for version, factor in ((0, 1), (1, 2)):
        doc = stats.stats_document(table.withColumn("n", table.n * factor))
        snapshots.write_version(doc, str(path), version, files=1, fmt="text")
    loaded = {(r.dimension, r.key): r.n for r in files.load_stats_document(spark, str(path), backup).collect()}
    assert loaded == {("severity", "LOW"): 4, ("total", "total"): 4}
    broken = tmp_path / "broken.json"
    broken.write_text('{"severity_counts": {"LOW"')
    for _ in range(2):
        assert files.load_stats_document(spark, str(broken), backup).count() == 0
    assert [r.raw for r in spark.read.parquet(backup).collect()] == ['{"severity_counts": {"LOW"'] * 2
    assert files.load_stats_document(spark, str(tmp_path / "none")).count() == 0
