"""Sessions as keyed state with event-time timers, and events looked up in them.

A session begins with the first event of its id. It is open from its first
login, if that comes within ``max_age`` of the beginning, and closed by the
first logout from then on; it expires ``max_age`` after the login or, without
one, after its beginning. Events up to that end belong to it, later ones don't.
``operators.sessions.lifecycle`` is the same over a table.

State per id: the session so far, folded in the order of event time, and the
events the watermark has not passed yet, as only those can still be preceded by
others. The end that the events so far suggest decides once the watermark is
behind it: by then nothing earlier can come, so the row is given out once and
does not change with the order of arrival or the cut into batches. The id is
remembered for ``remember`` after the end, so that events behind it can't open
the session anew, and then forgotten.

Every call for state or a timer is a round trip to the JVM, and a table has as
many ids as it has sessions. So a key of state is a bucket of ids: one value
with all its ids, one timer at the earliest end among them, and a handful of
calls per bucket and batch, however many ids it has. What an id holds is bounded
by its events within the lateness, whatever the length of the session. The
number of buckets belongs to the checkpoint.
"""

from __future__ import annotations

import json
import sys
from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from vigilog.operators.sessions import MAX_SESSION

# The processor travels with its code, so state workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
ROWS = ("session_id string, created_at timestamp, ended_at timestamp, first_seen timestamp, last_seen timestamp, "
        "events long, ends_at timestamp, state string")
BUCKETS = 4096


class Session(NamedTuple):
    """A session so far; times in microseconds."""

    first: int
    created: int | None
    ended: int | None
    last: int
    events: int

    def end(self, max_age: int) -> int:
        return self.ended if self.ended is not None else (self.first if self.created is None else self.created) + max_age


def fold(session: Session | None, events: list[tuple[int, int, bool, bool]], max_age: int) -> Session | None:
    """The session after further events (time, number, login, logout), which are sorted by time and distinct in it."""
    for at, n, login, logout in events:
        if session is None:
            session = Session(at, None, None, at, 0)
        if at > session.end(max_age):
            break
        created = at if login and session.created is None else session.created
        ended = at if logout and created is not None and session.ended is None else session.ended
        session = Session(session.first, created, ended, at, session.events + n)
    return session


def combine(events: list[tuple[int, int, bool, bool]]) -> list[tuple[int, int, bool, bool]]:
    """Events by time, those of one time together."""
    found: dict[int, tuple[int, int, bool, bool]] = {}
    for at, n, login, logout in events:
        _, m, was_login, was_logout = found.get(at, (at, 0, False, False))
        found[at] = (at, n + m, login or was_login, logout or was_logout)
    return [found[at] for at in sorted(found)]


class LifecycleProcessor(StatefulProcessor):
    def __init__(self, max_age: int, remember: int):
        self.max_age, self.remember = max_age, remember

    def init(self, handle):
        self.handle = handle
        self.held = handle.getValueState("held", "sessions string")

    def handleInputRows(self, key, rows, timerValues):
        new: dict[str, list[tuple[int, int, bool, bool]]] = {}
        for r in rows:
            new.setdefault(r.session_id, []).append((r.at, 1, r.login, r.logout))
        yield from self._go_on(new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._go_on({}, timerValues.getCurrentWatermarkInMs())

    def close(self):
        pass

    def _go_on(self, new, watermark_ms):
        """All ids of the bucket: those with new events, and those whose end or time to be forgotten has come."""
        passed = watermark_ms * 1000  # up to here, and including it, nothing can come any more
        state = self.held.get()
        held = {} if state is None else json.loads(state[0])
        kept, next_due = {}, None
        for session_id in {**held, **new}:
            session, waiting, forget = held.get(session_id, (None, [], None))
            if forget is None:
                session = None if session is None else Session(*session)
                waiting = combine([*map(tuple, waiting), *new.get(session_id, ())])
                session = fold(session, [e for e in waiting if e[0] <= passed], self.max_age)
                waiting = [e for e in waiting if e[0] > passed]
                due = fold(session, waiting, self.max_age).end(self.max_age)
                if due <= passed:
                    yield self._row(session_id, session, due)
                    session, waiting, forget = None, [], due + self.remember
            if forget is not None:
                due = forget
                if due <= passed:
                    continue
            kept[session_id] = (session, waiting, forget)
            next_due = due if next_due is None else min(next_due, due)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if kept:
            self.held.update((json.dumps(kept),))
            self.handle.registerTimer(-(-next_due // 1000))
        else:
            self.held.clear()

    def _row(self, session_id, session: Session, end: int) -> Row:
        def time(us):
            return None if us is None else _EPOCH + timedelta(microseconds=us)
        state = "unopened" if session.created is None else "expired" if session.ended is None else "closed"
        return Row(session_id=session_id, created_at=time(session.created), ended_at=time(session.ended),
                   first_seen=time(session.first), last_seen=time(session.last), events=session.events,
                   ends_at=time(end), state=state)


def _micros(spark, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {interval})").first()[0]


def session_rows(events: DataFrame, max_age: str = MAX_SESSION, lateness: str = "10 minutes", remember: str = "1 day",
                 buckets: int = BUCKETS) -> DataFrame:
    """One row per session when the watermark has passed its end (append mode).

    Events behind the watermark are left out; events without session id only
    move the watermark, as all events do; events without time are ignored.
    """
    spark = events.sparkSession
    kind = F.coalesce("event_type", F.lit(""))
    # A plain filter would be pushed below the watermark, which must see all events; one that is not deterministic stays.
    known = F.when(F.spark_partition_id() >= 0, F.col("session_id").isNotNull() & F.col("ts").isNotNull())
    rows = events.withWatermark("ts", lateness).filter(known).select(
        F.pmod(F.xxhash64("session_id"), F.lit(buckets)).alias("bucket"), "session_id", "ts", F.unix_micros("ts").alias("at"),
        (kind == "LOGIN_SUCCESS").alias("login"), (kind == "LOGOUT").alias("logout"))
    processor = LifecycleProcessor(_micros(spark, max_age), _micros(spark, remember))
    return rows.groupBy("bucket").transformWithState(processor, ROWS, "Append", "EventTime", eventTimeColumnName="ends_at")


def live_lookup(events: DataFrame, sessions: DataFrame, max_age: str = MAX_SESSION, lateness: str = "10 minutes") -> DataFrame:
    """Every event of a stream with the session that was live at its time, if any.

    An interval join of two streams: a session is kept until events can't be as
    old as its end, an event until no session that ended ``max_age`` after it
    can still come. Then an event without a live session is given out as such.
    """
    left = events.withWatermark("ts", lateness)
    right = sessions.filter(F.col("created_at").isNotNull()).select(
        F.col("session_id").alias("_id"), F.col("created_at").alias("_from"), F.col("ends_at").alias("_until"))
    within = (F.col("session_id") == F.col("_id")) & (F.col("ts") >= F.col("_from")) & (F.col("ts") <= F.col("_until")) \
        & (F.col("_until") <= F.col("ts") + F.expr(f"INTERVAL {max_age}"))
    joined = left.join(right, within, "left_outer")
    return joined.withColumns({"live": F.col("_id").isNotNull(), "session_start": F.col("_from")}).drop("_id", "_from", "_until")
