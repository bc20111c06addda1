"""Streaming operators run over the event table until it is used up, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilog.operators import sessions
from vigilog.plans import lookups, records, selection, statistics
from vigilog.plans.registry import query
from vigilog.plans.tables import as_records, event_table, located, se_cte, sec_events, table
from vigilog.session import scratch_dir
from vigilog.sinks import batches, snapshots
from vigilog.sources import files
from vigilog.streaming import ingest, lifecycle, timeline

SE = se_cte()


BATCHES = 4


def in_files(spark, sf_dir, flush=(), by="event_id"):
    """The event table in files of successive arrival or, ``by`` the column ``ts``, of successive times, as a log would grow;
    ``flush`` adds bare rows so much later, a file each. Row groups are small, so that many tasks read a file."""
    source = table(spark, sf_dir, "events")
    place = F.col(by) if by == "event_id" else F.unix_micros(F.col(by).cast("timestamp"))
    cuts = source.agg(F.percentile_approx(place, [i / BATCHES for i in range(1, BATCHES)], F.lit(10000)).alias("cuts")).first()["cuts"]
    path = f"{scratch_dir(spark, 'log')}/events.parquet"
    edges = [None, *sorted(set(cuts or ())), None]
    for low, high in zip(edges, edges[1:]):
        above = place.isNull() if low is None else F.lit(False)
        above |= (F.lit(True) if low is None else place > low) & (F.lit(True) if high is None else place <= high)
        source.filter(above).repartition(1).write.mode("append").option("parquet.block.size", 8 << 20).parquet(path)
    for after in flush:
        late = source.agg((F.max("ts") + F.expr(f"INTERVAL {after}")).alias("ts"))
        late.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(source.schema[c].dataType).alias(c) for c in source.columns]) \
            .coalesce(1).write.mode("append").parquet(path)
    return path


def stream_events(spark, sf_dir, with_location=False, path=None, spread=False):
    """The event log as a stream, its time as an instant: one batch, or with ``path`` a batch per file of it.

    ``spread`` deals the narrow source rows to all tasks, for queries whose work
    per row is large: a scan has no more tasks than the file has row groups.
    """
    source = table(spark, sf_dir, "events")
    rows = files.stream_table(spark, path or f"{sf_dir}/events.parquet", source.schema, 1 if path else None)
    if spread:
        rows = rows.repartition(4 * spark.sparkContext.defaultParallelism)
    flat = event_table(rows)
    if with_location:
        flat = located(flat, table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    return flat.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(stream, label, on_batch=None, mode="append"):
    """Run a stream to its end into a table on shared storage and open that table."""
    spark = stream.sparkSession
    root = scratch_dir(spark, label)
    out = f"{root}/out"
    steps = on_batch(out) if on_batch else batches.changed_rows(out)
    ingest.run_stream(stream, steps, f"{root}/checkpoint", mode).awaitTermination()
    return spark, out


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(SE + "SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n FROM se GROUP BY 1, 2")
def stream_minute_counts(spark, sf_dir):
    counts = ingest.minute_counts(stream_events(spark, sf_dir), lateness="31 days")
    spark, out = _drain(counts, "minutes", mode="update")
    return _ntz(batches.latest_rows(spark.read.parquet(out), ["minute", "event_type"]), "minute")


@query(SE + statistics.LONG_FORM)
def stream_running_totals(spark, sf_dir):
    totals = ingest.running_totals(stream_events(spark, sf_dir, with_location=True))
    spark, out = _drain(totals, "totals", mode="update")
    return batches.latest_rows(spark.read.parquet(out), ["dimension", "key"])


@query(SE + statistics.LONG_FORM)
def stream_stats_table(spark, sf_dir):
    """Statistics kept as a versioned table by the batch writer."""
    spark, out = _drain(stream_events(spark, sf_dir, with_location=True), "stats", batches.running_stats)
    return files.load_stats(spark, out)


@query(SE + "SELECT event_id, event_type FROM se")
def stream_dedup_indexed(spark, sf_dir):
    """The log sent twice in several batches, each event taken once by the index of seen ids, without a horizon."""
    path = in_files(spark, sf_dir)
    e = stream_events(spark, sf_dir, path=path).select("event_id", "arrival_seq", "event_type")
    again = e.withColumn("arrival_seq", F.col("arrival_seq") + F.lit(1000000000000))
    late = stream_events(spark, sf_dir).select("event_id", "arrival_seq", "event_type").filter("event_id % 10 = 3")
    spark, out = _drain(e.unionByName(again).unionByName(late), "dedup-indexed",
                        lambda path: batches.unseen(f"{path}/new", f"{path}/seen"))
    return spark.read.parquet(f"{out}/new").select("event_id", "event_type")


@query(SE + "SELECT event_id, event_type FROM se")
def stream_dedup(spark, sf_dir):
    """The log sent twice, each event taken once."""
    e = stream_events(spark, sf_dir)
    twice = e.unionByName(stream_events(spark, sf_dir)).select("event_id", "event_type", "ts")
    spark, out = _drain(ingest.dedup(twice, horizon="31 days"), "dedup")
    return spark.read.parquet(out).select("event_id", "event_type")


def _sampled(spark, sf_dir, sampling_on, path=None):
    e = stream_events(spark, sf_dir, path=path).select("event_id", "arrival_seq", "severity", F.to_date("ts").cast("string").alias("day"))
    spark, out = _drain(e, "sample", lambda path: batches.sampled(f"{path}/accepted", f"{path}/state", ["day"],
                                                                  sampling=sampling_on))
    return spark.read.parquet(f"{out}/accepted")


@query(SE + selection.LIMITED)
def stream_rate_limit(spark, sf_dir):
    return _sampled(spark, sf_dir, False).select("event_id", "day", "place")


@query(SE + selection.PRIORITY)
def stream_priority_sample(spark, sf_dir):
    return _sampled(spark, sf_dir, True).select("event_id", "day", "place", "accepted")


@query(SE + selection.LIMITED)
def stream_rate_limit_parts(spark, sf_dir):
    """The limit over several batches, whose borders lie inside of windows."""
    return _sampled(spark, sf_dir, False, in_files(spark, sf_dir)).select("event_id", "day", "place")


@query(SE + selection.PRIORITY)
def stream_priority_sample_parts(spark, sf_dir):
    return _sampled(spark, sf_dir, True, in_files(spark, sf_dir)).select("event_id", "day", "place", "accepted")


@query(SE + "SELECT event_id, ts, event_type FROM se ORDER BY arrival_seq DESC LIMIT 1000")
def stream_retained_parts(spark, sf_dir):
    e = stream_events(spark, sf_dir, path=in_files(spark, sf_dir)).select("event_id", "arrival_seq", "ts", "event_type")
    spark, out = _drain(e, "retained", batches.retained)
    return _ntz(spark.read.parquet(snapshots.latest_version(spark, out)).drop("arrival_seq"), "ts")


@query(SE + statistics.LONG_FORM)
def stream_stats_table_parts(spark, sf_dir):
    e = stream_events(spark, sf_dir, with_location=True, path=in_files(spark, sf_dir))
    spark, out = _drain(e, "stats", batches.running_stats)
    return files.load_stats(spark, out)


def _rolling(spark, sf_dir, horizon):
    e = stream_events(spark, sf_dir, path=in_files(spark, sf_dir)).select("ts", "event_type")
    spark, out = _drain(e, "timeline", lambda path: timeline.rolling(path, horizon))
    return _ntz(timeline.timeline(spark, out, horizon=horizon), "minute")


ROLLING = """SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n FROM se
  WHERE ts > date_trunc('second', (SELECT max(ts) FROM se) + INTERVAL 999999 MICROSECONDS) - INTERVAL {horizon} GROUP BY 1, 2"""


@query(SE + ROLLING.format(horizon="30 MINUTES"))
def stream_timeline(spark, sf_dir):
    """The rolling timeline after several batches, as of the newest second."""
    return _rolling(spark, sf_dir, "30 minutes")


@query(SE + ROLLING.format(horizon="1 DAY"))
def stream_timeline_day(spark, sf_dir):
    return _rolling(spark, sf_dir, "1 day")


@query(SE + "SELECT event_id, ts, event_type FROM se ORDER BY arrival_seq DESC LIMIT 1000")
def stream_retained(spark, sf_dir):
    e = stream_events(spark, sf_dir).select("event_id", "arrival_seq", "ts", "event_type")
    spark, out = _drain(e, "retained", batches.retained)
    return _ntz(spark.read.parquet(snapshots.latest_version(spark, out)).drop("arrival_seq"), "ts")


@query(SE + f"SELECT event_id, {records.LEVEL} AS log_level, severity IN ('HIGH', 'CRITICAL') AS severe FROM se")
def stream_routed(spark, sf_dir):
    """Both outputs of the severity router, joined again on the event."""
    e = stream_events(spark, sf_dir, with_location=True)
    spark, out = _drain(e, "routed", lambda path: batches.routed(f"{path}/main", f"{path}/severe"))
    main = spark.read.parquet(f"{out}/main").select("event_id", "log_level")
    severe = spark.read.parquet(f"{out}/severe").select("event_id", F.lit(True).alias("severe"))
    return main.join(severe, "event_id", "left").withColumn("severe", F.coalesce("severe", F.lit(False)))


@query(SE + f"""SELECT session_id, created_at, ended_at, first_seen, last_seen, events, CASE WHEN created_at IS NULL
      THEN 'unopened' WHEN ended_at >= created_at THEN 'closed' ELSE 'expired' END AS state
  FROM ({lookups.SESSIONS}) s
  WHERE CASE WHEN ended_at >= created_at THEN last_seen ELSE coalesce(created_at, first_seen) + INTERVAL 8 HOURS END
    < (SELECT max(ts) FROM se) - INTERVAL 10 MINUTES""")
def stream_session_lifecycle(spark, sf_dir):
    """Sessions that are over by the time the stream stops."""
    e = stream_events(spark, sf_dir).select("session_id", "event_type", "ts")
    spark, out = _drain(e, "sessions", lambda path: batches.session_log(f"{path}/ended", f"{path}/open"))
    return _ntz(spark.read.parquet(f"{out}/ended").drop("batch_id"), "created_at", "ended_at", "first_seen", "last_seen")


# Sessions with a fixed end; events behind it are outside.
LIFE = f""", life_1 AS (SELECT session_id, min(ts) AS f, min(CASE WHEN event_type = 'LOGIN_SUCCESS' THEN ts END) AS l
    FROM se WHERE session_id IS NOT NULL GROUP BY session_id),
  life_2 AS (SELECT session_id, CASE WHEN l <= f + INTERVAL 8 HOURS THEN l END AS created_at,
      CASE WHEN l <= f + INTERVAL 8 HOURS THEN l ELSE f END + INTERVAL 8 HOURS AS deadline FROM life_1),
  life_3 AS (SELECT a.session_id, created_at, deadline,
      min(CASE WHEN event_type = 'LOGOUT' AND ts >= created_at AND ts <= deadline THEN ts END) AS ended_at
    FROM life_2 a JOIN se b ON a.session_id = b.session_id GROUP BY a.session_id, created_at, deadline),
  life AS (SELECT a.session_id, created_at, ended_at, coalesce(ended_at, deadline) AS ends_at, min(ts) AS first_seen, max(ts) AS last_seen,
      count(*) AS events, CASE WHEN created_at IS NULL THEN 'unopened' WHEN ended_at IS NULL THEN 'expired' ELSE 'closed' END AS state
    FROM life_3 a JOIN se b ON a.session_id = b.session_id WHERE ts <= coalesce(ended_at, deadline)
    GROUP BY a.session_id, created_at, ended_at, deadline)"""
TIMES = ["created_at", "ended_at", "first_seen", "last_seen", "ends_at"]


@query(se_cte(LIFE) + "SELECT * FROM life")
def session_lifecycle(spark, sf_dir):
    e = sec_events(spark, sf_dir).select("session_id", "event_type", "ts")
    return sessions.lifecycle(e)


@query(se_cte(LIFE) + "SELECT * FROM life WHERE ends_at < (SELECT max(ts) FROM se) - INTERVAL 10 MINUTES")
def stream_session_state(spark, sf_dir):
    """Sessions as keyed state with timers, over a log of several files: those over when it stops."""
    e = stream_events(spark, sf_dir, path=in_files(spark, sf_dir, by="ts")).select("session_id", "event_type", "ts")
    spark, out = _drain(lifecycle.session_rows(e), "session-state")
    return _ntz(spark.read.parquet(out).drop("batch_id"), *TIMES)


@query(se_cte(LIFE) + """SELECT event_id, se.session_id, coalesce(ts >= created_at AND ts <= ends_at, false) AS live,
  CASE WHEN ts >= created_at AND ts <= ends_at THEN created_at END AS session_start
  FROM se LEFT JOIN life ON se.session_id = life.session_id""")
def stream_session_lookup(spark, sf_dir):
    """Every event of the log with its live session: two streams of several files, joined by interval."""
    path = in_files(spark, sf_dir, flush=["3 days", "6 days"], by="ts")
    columns = ["event_id", "session_id", "event_type", "ts"]
    events, again = (stream_events(spark, sf_dir, path=path).select(*columns) for _ in range(2))
    found = lifecycle.live_lookup(events, lifecycle.session_rows(again))
    spark, out = _drain(found, "session-lookup")
    return _ntz(spark.read.parquet(out).filter("event_id IS NOT NULL").select("event_id", "session_id", "live", "session_start"),
                "session_start")


ACCEPTED = se_cte(also=f""", kept AS (SELECT event_id FROM (
    SELECT *, CAST(sum(CASE WHEN candidate THEN 1 ELSE 0 END) OVER (PARTITION BY day ORDER BY place) AS BIGINT) AS accepted
    FROM (SELECT *, place <= 16 OR {selection.HIGH} OR place % 3 = 0 AS candidate
          FROM (SELECT event_id, severity, CAST(ts AS DATE) AS day,
                  row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY arrival_seq) AS place
                FROM se WHERE event_id % 19 <> 0) a) b) c
    WHERE candidate AND accepted <= 30),
  taken AS (SELECT * FROM se WHERE event_id IN (SELECT event_id FROM kept))""")


@query(ACCEPTED + statistics.LONG_FORM.replace("FROM se", "FROM taken"))
def stream_consume(spark, sf_dir):
    """The whole consumer on records, some of them broken or invalid: statistics of what it accepted."""
    records_ = as_records(stream_events(spark, sf_dir, with_location=True, spread=True))
    root = scratch_dir(spark, "consume")
    ingest.consume(records_, f"{root}/out", f"{root}/checkpoint", window_seconds=86400, horizon="31 days").awaitTermination()
    return files.load_stats(spark, f"{root}/out/stats")


@query(SE + "SELECT arrival_seq, 'unreadable record' AS reason FROM se WHERE arrival_seq % 19 = 0")
def stream_dead_letter(spark, sf_dir):
    """What the consumer's own batches refuse, beside what they pass on."""
    checked = ingest.checked_records(as_records(stream_events(spark, sf_dir, spread=True)))
    spark, out = _drain(checked, "dead", lambda path: batches.persisted(batches.checked(
        f"{path}/dead", f"{path}/invalid", lambda df, batch_id: batches.write_batch(df, f"{path}/good", batch_id))))
    return spark.read.parquet(f"{out}/dead").select("arrival_seq", "reason")
