"""Exact duplicates by digest, with a minimal perfect hash over the digests of a historical corpus."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.text import lower_ascii, mix
from vigilog.session import durable

DIGESTS_PER_SHARD = 50_000
KEYS_PER_BUCKET = 3
_STEP = np.uint64(0x9E3779B97F4A7C15)


def digests(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``digest`` (SHA-256 of the normalised text, 32 bytes), written once."""
    return durable(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(lower_ascii(F.col("text").cast("string")), 256)).alias("digest")), "digests")


def distinct(rows: DataFrame) -> DataFrame:
    """Each digest once with the locator of its winner (largest doc_id, then row; a null id is the smallest) and its rows."""
    winner = F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), F.col("row")))
    return rows.groupBy("digest").agg(winner.alias("winner"), F.count("*").alias("size"))


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


# --- the perfect hash of one shard

def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each digest (rows of 32 bytes)."""
    words = keys.reshape(-1, 32).view(np.uint64).reshape(-1, 4)
    return words[:, 0], words[:, 1]


def _slot(second: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    return (mix(second + shift * _STEP) % np.uint64(n)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Perfect hash of n distinct digests onto n slots: the displacement of each bucket, the slot of each digest.

    Buckets are placed from the largest to the smallest; the displacement is the
    first with which all digests of a bucket fall on free slots. A bucket of one
    digest names its slot: -1 - slot.
    """
    n = len(keys) // 32
    first, second = _halves(keys)
    buckets = n // KEYS_PER_BUCKET + 1
    bucket = (first % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    starts = np.cumsum(counts) - counts
    shifts, slots, taken = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    single = []
    for b in np.argsort(-counts, kind="stable"):
        size = counts[b]
        if size == 0:
            break
        members = order[starts[b]:starts[b] + size]
        if size == 1:
            single.append((b, members[0]))
            continue
        base, tries = 1, 16
        while True:
            tried = np.arange(base, base + tries, dtype=np.uint64)
            at = _slot(second[members][None, :], tried[:, None], n)
            good = ~taken[at].any(axis=1)
            for i in np.flatnonzero(good):
                if len(set(at[i].tolist())) == size:
                    shifts[b], slots[members] = base + int(i), at[i]
                    taken[at[i]] = True
                    break
            else:
                base, tries = base + tries, min(tries * 4, 4096)
                continue
            break
    free = np.flatnonzero(~taken)
    for (b, member), slot in zip(single, free):
        shifts[b], slots[member] = -1 - slot, slot
    return shifts, slots


def look_up(keys: np.ndarray, shifts: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """Slot of each digest whose 32 bytes the slot holds, -1 for nonmembers."""
    n = len(stored) // 32
    if not n:
        return np.full(len(keys) // 32, -1)
    first, second = _halves(keys)
    shift = shifts[(first % np.uint64(len(shifts))).astype(np.int64)]
    slot = np.where(shift < 0, -1 - shift, _slot(second, shift.astype(np.uint64), n))
    same = (stored.reshape(-1, 32)[slot] == keys.reshape(-1, 32)).all(axis=1)
    return np.where(same, slot, -1)


INDEX = "shard int, shifts binary, digests binary, ids binary, rows binary, sizes binary"


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: displacements, and per slot the full digest, the winner's locator and the number of rows."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(pdf["digest"]), np.uint8)
        shifts, slots = build(keys)
        order = np.argsort(slots)
        return pd.DataFrame({
            "shard": [pdf["shard"].iloc[0]], "shifts": [shifts.tobytes()],
            "digests": [keys.reshape(-1, 32)[order].tobytes()],
            "ids": [pdf["doc_id"].to_numpy(np.int64)[order].tobytes()],
            "rows": [pdf["row"].to_numpy(np.int64)[order].tobytes()],
            "sizes": [pdf["size"].to_numpy(np.int64)[order].tobytes()]})

    keyed = history.select(_shard(F.col("digest"), shards).alias("shard"), "digest", "winner.doc_id", "winner.row", "size")
    return keyed.groupBy("shard").applyInPandas(one, INDEX)


GROUPS = "digest binary, doc_id long, row long, size long, member boolean"


def merge(index: DataFrame, arrivals: DataFrame, shards: int) -> DataFrame:
    """All groups after the arrivals: slots with the members found in them, and groups of nonmembers."""

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        def column(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(left[name].iloc[0] if len(left) else b"", kind)

        stored, shifts = column("digests", np.uint8), column("shifts", np.int64)
        ids, rows, sizes = (column(x, np.int64).copy() for x in ("ids", "rows", "sizes"))
        keys = np.frombuffer(b"".join(right["digest"]), np.uint8)
        slot = look_up(keys, shifts, stored)
        hit = slot >= 0
        new_ids, new_rows, new_sizes = (right[x].to_numpy(np.int64) for x in ("doc_id", "row", "size"))
        at = slot[hit]  # digests of arrivals are distinct, so slots are
        later = (new_ids[hit] > ids[at]) | ((new_ids[hit] == ids[at]) & (new_rows[hit] > rows[at]))
        ids[at], rows[at] = np.where(later, new_ids[hit], ids[at]), np.where(later, new_rows[hit], rows[at])
        sizes[at] += new_sizes[hit]
        blob = stored.tobytes()
        return pd.DataFrame({
            "digest": [blob[i:i + 32] for i in range(0, len(blob), 32)] + list(right["digest"][~hit]),
            "doc_id": np.r_[ids, new_ids[~hit]], "row": np.r_[rows, new_rows[~hit]], "size": np.r_[sizes, new_sizes[~hit]],
            "member": np.r_[np.ones(len(ids), bool), np.zeros(int((~hit).sum()), bool)]})

    keyed = arrivals.select(_shard(F.col("digest"), shards).alias("shard"), "digest", "winner.doc_id", "winner.row", "size")
    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(one, GROUPS)


def deduplicate(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """One row per row of both: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``known``.

    ``history`` and ``arrivals`` are results of ``digests`` (rows numbered apart).
    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The row with the largest doc_id of a group stays; a null id is the smallest,
    and of repeated rows with that id one stays. ``known`` says that the text was
    in the history. Other columns are not read.

    Digests are combined per text before every shuffle, so a group of copies is
    one row in the index; only the last join, one row per text against all rows,
    meets the copies, and Spark splits such a partition.
    """
    rows = history.union(arrivals)
    old, new = durable(distinct(history), "history"), durable(distinct(arrivals), "arrivals")
    shards = int(max(old.count(), new.count()) // DIGESTS_PER_SHARD + 1)
    index = durable(build_index(old, shards), "index")
    groups = durable(merge(index, new, shards), "groups").select(
        "digest", F.col("doc_id").alias("best"), F.col("row").alias("best_row"), "size", "member")
    return rows.join(groups, "digest").select(
        "doc_id", F.when(F.col("best") != -(1 << 63), F.col("best")).alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("member").alias("known"))
