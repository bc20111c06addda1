"""Progress of running queries."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from vigilog import schema as S

METRICS = "vigilog"
DISTRIBUTIONS = {"event_type": S.EVENT_TYPES, "severity": S.SEVERITIES, "user_type": S.USER_TYPES}
OTHER = "(other)"


def observed(events: DataFrame, name: str = METRICS) -> DataFrame:
    """Count total, severe events and broken times while the query runs; costs no extra job.

    The distributions over the known types, severities and user types that the
    events have come along in the same pass; anything else, null included, is
    one more value.
    """
    counts = []
    for dimension, values in DISTRIBUTIONS.items():
        if dimension in events.columns:
            known = F.coalesce(F.col(dimension).isin(*values), F.lit(False))
            counts += [F.count_if(F.col(dimension) == v).alias(f"{dimension}={v}") for v in values]
            counts.append(F.count_if(~known).alias(f"{dimension}={OTHER}"))
    return events.observe(name, F.count(F.lit(1)).alias("events"),
                          F.count_if(F.col("severity").isin("HIGH", "CRITICAL")).alias("severe"),
                          F.count_if(F.col("ts").isNull()).alias("without_time"), *counts)


class ProgressLog(StreamingQueryListener):
    """Running totals of the observed metrics; ``report`` gets a line every ``every`` events."""

    def __init__(self, report=print, every: int = 100, name: str = METRICS):
        self.report, self.every, self.name = report, every, name
        self.batches = self.events = self.severe = self._reported = 0
        self.counts: Counter[tuple[str, str]] = Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches += 1
        self.events += row["events"]
        self.severe += row["severe"]
        for field, n in row.asDict().items():
            dimension, found, value = field.partition("=")
            if found and n:
                self.counts[dimension, value] += n
        if self.events // self.every > self._reported:
            self._reported = self.events // self.every
            self.report(f"{self.events} events, {self.severe} severe, {self.batches} batches, "
                        f"{event.progress.processedRowsPerSecond:.2f} rows/s; {self.top('event_type')}")

    def top(self, dimension: str, k: int = 3) -> str:
        """The most frequent values of a distribution so far as text."""
        found = sorted(((n, v) for (d, v), n in self.counts.items() if d == dimension), key=lambda x: (-x[0], x[1]))
        return ", ".join(f"{v} {n}" for n, v in found[:k])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
