"""Operators against brute force, on data where one key holds a third of the rows and on random data."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from vigilog.operators import correlation, dedup, enrich, ordered, sampling, sessions, views

N = 3000
# Above how many rows a group counts as hot: none, the largest only, every group.
HOT = pytest.mark.parametrize("hot", [100_000, 800, 0])


@pytest.fixture(scope="module")
def log():
    """(arrival_seq, user, epoch seconds, type, severity); user u0 has a third of the rows, some users are null."""
    rng = random.Random(7)
    out = []
    for i in range(N):
        user = "u0" if rng.random() < 0.34 else rng.choice(["u1", "u2", "u3", "u4", "u5", None])
        at = rng.randrange(0, 3 * 86400) if i % 3 else 40000 + i // 3
        out.append((i, user, at, rng.choice(["LOGIN_FAILURE", "LOGIN_SUCCESS", "LOGOUT"]),
                    rng.choice(["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL"])))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def events(spark, log):
    df = spark.createDataFrame(log, "arrival_seq long, user_id string, at long, event_type string, severity string")
    return df.withColumn("ts", F.timestamp_seconds("at")).repartition(5).persist()


def per_user(log):
    groups = {}
    for r in log:
        groups.setdefault(r[1], []).append(r)
    return groups


@HOT
def test_running_number_per_user(events, log, hot):
    want = []
    for user, members in per_user(log).items():
        failures = sorted((r for r in members if r[3] == "LOGIN_FAILURE"), key=lambda r: (r[2], r[0]))
        want += [(r[0], n, user) for n, r in enumerate(failures, 1)]
    got = sessions.login_attempts(events, 1800, hot).select("arrival_seq", "attempt_number", "user_id")
    assert rows(got) == sorted(want, key=repr)


@HOT
def test_running_sum_of_values(events, log, hot):
    want = []
    for user, members in per_user(log).items():
        total = 0
        for r in sorted(members, key=lambda r: r[0]):
            total += r[2]
            want.append((r[0], total))
    got = ordered.running_sum(events, ["user_id"], ["arrival_seq"], F.col("at"), F.floor(F.col("arrival_seq") / 100), "t",
                              hot)
    assert rows(got.select("arrival_seq", "t")) == sorted(want, key=repr)


@HOT
def test_previous_row_across_buckets(events, log, hot):
    want = []
    for user, members in per_user(log).items():
        seqs = sorted(r[0] for r in members)
        want += [(s, p) for s, p in zip(seqs, [None] + seqs, strict=False)]
    got = ordered.previous(events, ["user_id"], ["arrival_seq"], {"arrival_seq": "prev"}, F.floor(F.col("arrival_seq") / 50),
                           hot)
    assert rows(got.select("arrival_seq", "prev")) == sorted(want, key=repr)


@HOT
def test_gap_sessions(events, log, hot):
    gap, want = 900, []
    for user, members in per_user(log).items():
        times, no, start, n = sorted(r[2] for r in members), 0, None, 0
        for t, following in zip(times, times[1:] + [None], strict=True):
            start, n = (t if start is None else start), n + 1
            if following is None or following - t > gap:
                no += 1
                want.append((t, n, no, start, user))
                start, n = None, 0
    got = sessions.gap_sessions(events, gap, hot_rows=hot).select(
        "user_id", "session_no", "events", F.unix_seconds("started_at").alias("started_at"),
        F.unix_seconds("ended_at").alias("ended_at"))
    assert rows(got) == sorted(want, key=repr)


@HOT
def test_lookup_with_hot_key(spark, events, log, hot):
    table = spark.createDataFrame([(f"u{i}", i * 10) for i in range(5)], "user_id string, x int")
    known = {f"u{i}": i * 10 for i in range(5)}
    got = enrich.lookup_hot(events.select("arrival_seq", "user_id"), table, "user_id", hot)
    assert rows(got) == sorted(((r[0], r[1], known.get(r[1])) for r in log), key=repr)


@HOT
def test_links_of_a_huge_chain(events, log, hot):
    chained = events.withColumns({"correlation_id": F.when(F.col("user_id") != "u5", F.col("user_id")).otherwise(""),
                                  "event_id": F.col("arrival_seq")})
    want = []
    for user, members in per_user(log).items():
        if user in (None, "u5"):
            continue
        seqs = sorted(r[0] for r in members)
        want += list(zip(seqs[1:], seqs, strict=False))
    got = correlation.linked_pairs(chained, 64, hot).select("arrival_seq", "prev_event_id")
    assert rows(got) == sorted(want, key=repr)
    sizes = {r.correlation_id: r.events for r in correlation.chains(chained).collect()}
    assert sizes == {u: len(m) for u, m in per_user(log).items() if u not in (None, "u5")}


def test_keep_first_of_a_hot_id(events, log):
    want = [(min(r[0] for r in m), u) for u, m in per_user(log).items() if u is not None]
    want += [(r[0], None) for r in log if r[1] is None]
    got = dedup.keep_first(events, key="user_id").select("user_id", "arrival_seq")
    assert rows(got) == sorted(want, key=repr)
    once = dedup.keep_first(dedup.keep_first(events, "user_id"), "user_id").select("user_id", "arrival_seq")
    assert rows(once) == rows(got)


def test_append_is_idempotent(events):
    e = events.filter("user_id is not null").withColumn("event_id", F.col("arrival_seq") % 700)
    history = dedup.append_new(e.limit(0), e.filter("arrival_seq < 500"))
    grown = dedup.append_new(history, e)
    assert grown.count() == grown.select("event_id").distinct().count() == e.select("event_id").distinct().count()
    assert dedup.append_new(grown, e).count() == grown.count()


@pytest.mark.parametrize("field,ascending", [
    ("Time", False), ("Time", True), ("Severity", False), ("Severity", True), ("User", True), ("User", False)])
def test_positions_and_pages_of_a_sorted_view(events, log, field, ascending):
    rank = {"INFO": 1, "LOW": 2, "MEDIUM": 3, "HIGH": 4, "CRITICAL": 5}
    key = {"Time": lambda r: r[2], "Severity": lambda r: rank[r[4]], "User": lambda r: r[1] or ""}[field]
    # Python's reverse sort keeps ties in their first order, like ours.
    want = [r[0] for r in sorted(sorted(log, key=lambda r: r[0]), key=key, reverse=not ascending)]
    placed = views.sorted_positions(events, field, ascending).orderBy("pos").select("pos", "arrival_seq").collect()
    assert [r.pos for r in placed] == list(range(1, N + 1))
    assert [r.arrival_seq for r in placed] == want

    size, seen, last = 700, [], None
    for number in range(1, 6):
        page = views.page(events, number, size, field, ascending).collect()
        assert [r.arrival_seq for r in page] == want[(number - 1) * size:number * size]
        if last is not None:
            following = views.page_after(events, key_of(last, field, rank), last.arrival_seq, size, field, ascending)
            assert [r.arrival_seq for r in following.collect()] == [r.arrival_seq for r in page]
        seen += page
        last = page[-1]
    assert [r.arrival_seq for r in seen] == want


def key_of(row, field, rank):
    return {"Time": row.ts, "Severity": rank[row.severity], "User": row.user_id or ""}[field]


def sequential_sample(severities, budget):
    """The rule as a loop: what the sampler must accept, in order."""
    accepted, c = [], 0
    for i, s in enumerate(severities):
        if len(accepted) >= budget:
            break
        c += 1
        if s not in ("HIGH", "CRITICAL") and c % 3 != 0 and len(accepted) > budget / 2:
            continue
        accepted.append(i)
    return accepted


def test_sampler_with_a_hot_window(events, log):
    for budget in (1, 2, 7, 30, 400):
        want = []
        for user, members in per_user(log).items():
            members = sorted(members, key=lambda r: r[0])
            want += [members[i][0] for i in sequential_sample([r[4] for r in members], budget)]
        got = sampling.priority_sample(events, ["user_id"], budget).select("arrival_seq").collect()
        assert sorted(r.arrival_seq for r in got) == sorted(want)


def test_only_severe_events_stop_at_the_budget(spark):
    df = spark.range(200).select(F.col("id").alias("arrival_seq"), F.lit("HIGH").alias("severity"), F.lit(1).alias("w"))
    assert sampling.priority_sample(df, ["w"], 30).count() == 30


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["INFO", "MEDIUM", "HIGH", "CRITICAL"]), max_size=60), min_size=1, max_size=30),
       st.integers(1, 20))
def test_sampler_closed_form_equals_the_loop(spark, windows, budget):
    data = [(w, i, s) for w, seq in enumerate(windows) for i, s in enumerate(seq)]
    if not data:
        return
    df = spark.createDataFrame(data, "w int, arrival_seq long, severity string")
    want = sorted((w, i) for w, seq in enumerate(windows) for i in sequential_sample(seq, budget))
    got = sampling.priority_sample(df, ["w"], budget).select("w", "arrival_seq").collect()
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("budget", [10, 4000])
def test_sampling_of_one_window_with_any_budget(spark, budget):
    """A third of all events in one window, and a budget on either side of what Spark cuts before the shuffle."""
    from vigilog.operators import sampling
    n = 20_000
    e = spark.range(n).select(
        F.col("id").alias("arrival_seq"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("w"),
        F.when(F.col("id") % 7 == 0, "HIGH").otherwise("INFO").alias("severity"))
    got = {}
    for r in sampling.priority_sample(e, ["w"], budget).collect():
        got.setdefault(r.w, []).append((r.place, r.arrival_seq, r.accepted))
    windows = {}
    for i in range(n):
        windows.setdefault(0 if i % 3 == 0 else i % 500, []).append((i, i % 7 == 0))
    for w, events in windows.items():
        accepted, want = 0, []
        for place, (i, high) in enumerate(events, 1):
            if accepted >= budget:
                break
            if high or place % 3 == 0 or accepted <= budget // 2:
                accepted += 1
                want.append((place, i, accepted))
        assert sorted(got.get(w, [])) == want
