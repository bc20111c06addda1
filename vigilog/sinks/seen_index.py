"""History of seen ids in hash buckets with a Bloom filter each.

A new batch of ids is compared with the filters first, at ``BITS`` bits per
seen id instead of the id. Only buckets in which an id may stand are read, and
an id that passed a filter by chance is found out there, so the answer is exact.
The history is never shuffled: the ids in question of some buckets at a time,
``MOST_IDS`` of them or one bucket's, are broadcast to the files of those
buckets.

Layout below one folder: ``level=L/ids/version=V/bucket=B`` and
``level=L/filters/version=V`` with one row per bucket that the version added to.
Level 0 has what single batches added; a repeated batch writes its version
again, and readers of a batch take only the versions before it. ``compact``
merges ``FAN`` neighbours of a level into one version of the next, so filters
and files per bucket grow with the logarithm of the number of batches. A merged
version counts once it is complete, and only then those below it are removed.

``buckets`` should be so many that the ids of one bucket in the largest batch
fit a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.session import durable
from vigilog.sinks import snapshots

BUCKETS = 256
BITS, PROBES = 20, 6
MOST_IDS = 1_000_000
FAN, LEVELS = 8, 8

Version = tuple[int, int]
_IDS = "id string, h1 long, h2 long, bucket int"
_FILTER = "bucket int, width long, bits binary"


def _keys(ids: DataFrame, key: str, buckets: int) -> DataFrame:
    """Distinct ids as text with their bucket and two hashes for the filter."""
    text = F.col(key).cast("string")
    return ids.select(text.alias("id")).filter("id is not null").distinct().select(
        "id", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(buckets)).cast("int").alias("bucket"),
        F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(2)).alias("h2"))


def _slots(h1: np.ndarray, h2: np.ndarray, width: int) -> np.ndarray:
    """Bit numbers of every id, one row per probe."""
    step = h2.astype(np.uint64) | np.uint64(1)
    at = [(h1.astype(np.uint64) + np.uint64(k) * step) for k in range(PROBES)]
    return np.array([(a ^ (a >> np.uint64(29))) % np.uint64(width) for a in at], np.int64)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def make_filter(bucket: int, h1: np.ndarray, h2: np.ndarray, bits: int = BITS) -> pa.Table:
    width = max(64, -(-len(h1) * bits // 8) * 8)
    field = np.zeros(width, bool)
    field[_slots(h1, h2, width).ravel()] = True
    return pa.table({"bucket": pa.array([bucket], pa.int32()), "width": pa.array([width], pa.int64()),
                     "bits": pa.array([np.packbits(field).tobytes()], pa.binary())})


def may_hold(h1: np.ndarray, h2: np.ndarray, width: int, bits: bytes) -> np.ndarray:
    field = np.frombuffer(bits, np.uint8)
    at = _slots(h1, h2, width)
    return ((field[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(0)


class SeenIndex:
    """Ids seen so far; see the module. ``buckets`` and ``bits`` belong to the folder and must not change."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bits: int = BITS, most_ids: int = MOST_IDS):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets, self.bits, self.most_ids = buckets, bits, most_ids

    def versions(self, before: int | None = None) -> list[Version]:
        """Complete versions of batches below ``before``, without those that a merged one covers."""
        live: list[Version] = []
        for level in reversed(range(LEVELS)):
            span = FAN ** level
            for number in snapshots.committed_versions(self.spark, f"{self.path}/level={level}/filters"):
                start = number * span
                covered = any(n * FAN ** k <= start < (n + 1) * FAN ** k for k, n in live)
                if not covered and (before is None or start + span <= before):
                    live.append((level, number))
        return sorted(live, key=lambda v: v[1] * FAN ** v[0])

    def _path(self, kind: str, version: Version) -> str:
        return snapshots.version_path(f"{self.path}/level={version[0]}/{kind}", version[1])

    def add(self, ids: DataFrame, key: str, version: int) -> None:
        """Add the ids of a batch; the filter is written last and makes the version count."""
        self._write(durable(_keys(ids, key, self.buckets), "seen-new"), (0, version))

    def _write(self, keys: DataFrame, version: Version) -> None:
        bits = self.bits

        def build(group: tuple, table: pa.Table) -> pa.Table:
            return make_filter(group[0].as_py(), _numbers(table, "h1"), _numbers(table, "h2"), bits)

        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._path("ids", version))
        rows = keys.groupBy("bucket").applyInArrow(build, _FILTER)
        rows.write.mode("overwrite").parquet(self._path("filters", version))

    def possible(self, keys: DataFrame, versions: list[Version]) -> DataFrame:
        """Ids that a filter does not rule out: id, bucket. Filters meet the ids of their bucket in one task."""
        def probe(_, ids: pa.Table, filters: pa.Table) -> pa.Table:
            h1, h2 = _numbers(ids, "h1"), _numbers(ids, "h2")
            hit = np.zeros(ids.num_rows, bool)
            for width, bits in zip(filters.column("width").to_pylist(), filters.column("bits"), strict=True):
                hit |= may_hold(h1, h2, width, bits.as_py())
            return ids.filter(pa.array(hit)).select(["id", "bucket"])

        filters = self.spark.read.schema(_FILTER).parquet(*[self._path("filters", v) for v in versions])
        return keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, "id string, bucket int")

    def history(self, versions: list[Version]) -> DataFrame:
        rows = [self.spark.read.schema(_IDS).parquet(self._path("ids", v)) for v in versions]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out

    def seen(self, ids: DataFrame, key: str, before: int | None = None) -> DataFrame:
        """Distinct ids (as text, column ``id``) that the index holds."""
        versions = self.versions(before)
        if not versions:
            return ids.select(F.col(key).cast("string").alias("id")).limit(0)
        asked = durable(self.possible(_keys(ids, key, self.buckets), versions), "seen-possible")
        history = self.history(versions)
        found = [self._in_buckets(history, asked, chunk) for chunk in self._chunks(asked)]
        out = asked.select("id").limit(0)
        for part in found:
            out = out.unionByName(part)
        return out

    def _chunks(self, asked: DataFrame) -> list[list[int]]:
        """Buckets to be read, in groups with at most ``most_ids`` ids in question (or one bucket)."""
        chunks, size = [], 0
        for row in asked.groupBy("bucket").count().orderBy("bucket").collect():  # one row per bucket
            if not chunks or size + row["count"] > self.most_ids:
                chunks.append([])
                size = 0
            chunks[-1].append(row["bucket"])
            size += row["count"]
        return chunks

    @staticmethod
    def _in_buckets(history: DataFrame, asked: DataFrame, buckets: list[int]) -> DataFrame:
        some = F.col("bucket").isin(buckets)
        rows = history.filter(some).select("id", "bucket")
        return rows.join(F.broadcast(asked.filter(some)), ["id", "bucket"], "left_semi").select("id")

    def drop_seen(self, events: DataFrame, key: str = "event_id", before: int | None = None) -> DataFrame:
        """Events whose key the index does not hold; an event without a key is never seen."""
        seen = durable(self.seen(events, key, before), "seen")
        return events.join(seen.withColumnRenamed("id", "_seen"), F.col(key).cast("string") == F.col("_seen"), "left_anti")

    def compact(self, before: int) -> None:
        """Merge the versions of batches below ``before``, level by level; safe to repeat."""
        for level in range(1, LEVELS):
            span = FAN ** level
            for number in range(before // span):
                parts = [v for v in self.versions(before) if v[0] < level and number * span <= v[1] * FAN ** v[0] < (number + 1) * span]
                if len(parts) > 1:
                    self._write(durable(self.history(parts).dropDuplicates(["id"]), "seen-merge"), (level, number))
        self._clean()

    def _clean(self) -> None:
        """Remove what merged versions cover, filters first, as they make a version count."""
        live = self.versions()
        for level, number in ((k, n) for k in range(LEVELS) for n in snapshots.committed_versions(self.spark, f"{self.path}/level={k}/filters")):
            if (level, number) not in live:
                for kind in ("filters", "ids"):
                    snapshots.reset(self.spark, self._path(kind, (level, number)))
