"""Near-duplicate documents by the Jaccard similarity of their five-word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm import similarity
from vigilog.llm.text import WordHash, bitmap, input_columns, raw, set_hash, shingle_sets
from vigilog.session import durable

COMMON_IN_CHUNK = 2      # documents of a chunk that must share a shingle for it to be counted
COMMON_MOST = 400_000    # frequent shingles handed to every task (7 MB)
_CHUNK = 2_000_000
_LAST = (1 << 63) - 1      # stands for a null doc_id, after all others


def _scan(docs: DataFrame) -> DataFrame:
    """Kind 0: documents with class and size. Kind 1: frequent shingles (cls) and their count (n). Kind 2: classes with a
    row that has them and their bitmap."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen, held, size = WordHash(), set(), [], 0
        for batch in batches:
            classes, sizes, fresh, bits = [], [], [], []
            for i, shingles in enumerate(shingle_sets(raw(batch.column("text")), cache)):
                cls = set_hash(shingles)
                classes.append(cls)
                sizes.append(len(shingles))
                if cls and cls not in seen:
                    seen.add(cls)
                    fresh.append(i)
                    bits.append(bitmap(shingles))
                    held.append(shingles)
                    size += len(shingles)
                if size >= _CHUNK:
                    yield frequent(held)
                    held, size = [], 0
            classes, sizes = np.array(classes, np.int64), np.array(sizes, np.int64)
            yield rows(0, batch.column("row"), batch.column("doc_id"), classes, sizes)
            yield rows(2, batch.column("row").take(pa.array(fresh, pa.int64())), None, classes[fresh], sizes[fresh], bits)
        yield frequent(held)

    def frequent(held: list) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
        keep = counts >= COMMON_IN_CHUNK
        return rows(1, None, None, values[keep].view(np.int64), counts[keep].astype(np.int64))

    def rows(kind: int, row, doc_id, cls: np.ndarray, n: np.ndarray, bits=None) -> pa.RecordBatch:
        none = pa.nulls(len(cls), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(cls), pa.int32()), none if row is None else row, none if doc_id is None else doc_id, pa.array(cls),
             pa.array(n), pa.array(bits or [None] * len(cls), pa.list_(pa.int64()))], ["kind", "row", "doc_id", "cls", "n", "bits"])

    return docs.mapInArrow(scan, "kind int, row long, doc_id long, cls long, n long, bits array<long>")


class Order:
    """One order of shingles for all tasks: those not known as frequent first, then by count, then by value."""

    def __init__(self, values: np.ndarray, counts: np.ndarray):
        order = np.argsort(values)
        self.values, self.counts = values[order], counts[order]
        self.hint = np.zeros(1 << 20, bool)
        self.hint[(self.values >> np.uint64(44)).astype(np.int64)] = True

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        """The first n - ceil(3n/4) + 1 shingles of a sorted set.

        Sets with similarity 0.75 or more have one of these in common, whatever the order is.
        """
        n = len(shingles)
        count = n - (3 * n + 3) // 4 + 1
        maybe = np.flatnonzero(self.hint[(shingles >> np.uint64(44)).astype(np.int64)])
        if not len(maybe):
            return shingles[:count]
        known = np.zeros(n, np.int64)
        at = np.minimum(np.searchsorted(self.values, shingles[maybe]), len(self.values) - 1)
        known[maybe] = np.where(self.values[at] == shingles[maybe], self.counts[at], 0)
        return shingles[np.argsort(known, kind="stable")[:count]]


def _postings(docs: DataFrame, order, parts: int) -> DataFrame:
    flush, hot_local = similarity.FLUSH, similarity.HOT_LOCAL  # as the driver has them

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen, keys, classes, bands, limits, size = WordHash(), set(), [], [], [], [], 0
        for batch in batches:
            for shingles in shingle_sets(raw(batch.column("text")), cache):
                cls = set_hash(shingles)
                if not len(shingles) or cls in seen:
                    continue
                seen.add(cls)
                chosen = order.value.prefix(shingles)
                keys.append((chosen >> np.uint64(32)).astype(np.uint32))
                classes.append(np.full(len(chosen), cls, np.int64))
                bands.append(np.full(len(chosen), similarity.size_band(np.array([len(shingles)]))[0]))
                limits.append(similarity.partner_limit(len(shingles), len(chosen)))
                size += len(chosen)
                if size >= flush:
                    yield similarity.pack(*map(np.concatenate, (keys, classes, bands, limits)), parts, hot_local)
                    keys, classes, bands, limits, size = [], [], [], [], 0
        if size:
            yield similarity.pack(*map(np.concatenate, (keys, classes, bands, limits)), parts, hot_local)

    return docs.mapInArrow(post, similarity.POSTINGS)


def _contents(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sets of the wanted classes, read from one row each, beside the columns of ``wanted``."""
    chosen = durable(wanted.join(classes.select("cls", "row"), "cls"), "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(similarity.class_filter(chosen.select("row")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for batch in batches:
            mine = batch.filter(pa.array(similarity.may_have(bits.value, batch.column("row").to_numpy(zero_copy_only=False))))
            items = [x.tobytes() for x in shingle_sets(raw(mine.column("text")), cache)]
            yield pa.RecordBatch.from_arrays([mine.column("row"), pa.array(items, pa.binary())], ["row", "items"])

    return docs.mapInArrow(fetch, "row long, items binary").join(similarity.few(chosen), "row").select(*wanted.columns, "items")


def joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole join: documents as by ``near_duplicates`` but with ``links`` as the exact number of classes that theirs links
    with, and all links as pairs of classes ``a`` < ``b``, each once. Their documents are those with these ``cls``.

    Components come first, with only as many checks as they need; then all classes of a component are compared in blocks.
    That is quadratic in the size of a component, as the links of near copies are, but no row is made for a pair unless pairs are asked for."""
    return _joined(docs, True)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``row``, ``doc_id``, ``n_shingles``, ``component_id``, ``keep``, ``cls``, ``links``.

    Documents link when the Jaccard similarity of their sets of five-word
    shingles is 0.75 or more. A document with fewer words has its whole sequence
    as its one shingle; one without words (null and empty texts too) has no
    shingle, links with nothing, and is its own component. ``component_id`` is the smallest doc_id that links
    lead to; null doc_ids are passed over and stay only where a component has no
    other. Repeated rows give repeated rows. ``keep`` marks
    one row of each component. ``cls`` names the set, 0 for none; ``links`` is whether the
    class has a link to another class. ``row`` is the row's number in the scan. Other columns are not read.

    The shingles of each distinct set are put in one order, rarest first as far
    as known, and a set enters one tile per shingle of its prefix and band of
    its size. Within tiles, bit counts of hashed bitmaps bound the overlap before
    sorted arrays are intersected. Only as many links are checked as the components need; ``joined`` has them all.
    """
    return _joined(docs, False)[0]


def _joined(docs: DataFrame, every: bool) -> tuple[DataFrame, DataFrame | None]:
    spark = docs.sparkSession
    docs = input_columns(docs).select("*", F.monotonically_increasing_id().alias("row"))
    scanned = durable(_scan(docs), "sets")
    top = scanned.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "cls").limit(COMMON_MOST).toArrow()
    order = spark.sparkContext.broadcast(Order(top.column("cls").to_numpy().view(np.uint64), top.column("n").to_numpy()))
    del top
    classes = durable(scanned.where("kind = 2").groupBy("cls").agg(
        F.min("row").alias("row"), F.first("n").alias("n")), "classes")
    sets = scanned.where("kind = 0").select("row", "doc_id", "cls", "n")
    entries = sets.agg(F.coalesce(F.sum(F.expr("n div 4 + 1")), F.lit(0))).first()[0]
    parts = int(max(4, entries // similarity.ENTRIES_PER_PART + 1))
    tiles = durable(similarity.shared_tiles(_postings(docs, order, parts), parts), "tiles")
    order.unpersist()  # tiles are written; the driver need not hold it until its garbage is collected
    tiled = durable(tiles.select("cls").distinct(), "tiled")
    marks = durable(similarity.among(scanned.where("kind = 2").select("cls", "n", "bits"), tiled).groupBy("cls").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits")).join(tiled, "cls", "left_semi"), "marks")
    fetch = lambda wanted: _contents(docs, classes, wanted)
    linked = durable(similarity.link(tiles, marks, lambda wanted: durable(fetch(wanted), "items")), "linked")
    cells = similarity.cells(linked, marks, fetch) if every else None  # links are within components

    first = F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), F.col("row")))
    rooted = sets.where("cls <> 0").groupBy("cls").agg(first.alias("least")) \
        .join(linked, F.col("cls") == F.col("node"), "left") \
        .select("cls", "least", F.coalesce("root", "cls").alias("root"), F.col("node").isNotNull().alias("links"))
    best = rooted.where("links").groupBy("root").agg(F.min("least").alias("best"))
    named = rooted.join(best, "root", "left").select("cls", "links", F.coalesce("best", "least").alias("best"))
    if every:
        named = named.drop("links").join(similarity.link_counts(cells), "cls", "left")
    none = F.lit(0).cast("long") if every else F.lit(False)
    return sets.join(named, "cls", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("best").isNull(), F.col("doc_id")).when(F.col("best.doc_id") != _LAST, F.col("best.doc_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("keep"),
        "cls", F.coalesce("links", none).alias("links")), similarity.all_links(cells) if every else None


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each group of near duplicates: the smallest doc_id, of repeated rows the first."""
    gone = near_duplicates(docs).where("not keep").select(F.col("row").alias("_gone"))
    numbered = docs.select(F.struct("*").alias("own"), F.monotonically_increasing_id().alias("row"))
    return numbered.join(gone, numbered["row"] == gone["_gone"], "left_anti").select("own.*")
