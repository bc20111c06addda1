"""Links between sets that share a tile: bounded by bitmaps, then checked exactly.

A class is a distinct set, named by its 64-bit hash. ``tiles`` (tile, cls) says
which classes may be similar; ``contents`` (cls, n, bits, items) holds the sets.
Two classes link when 7 * common >= 3 * (n + n'), which is a Jaccard similarity
of 0.75 or more, without division.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.components import components
from vigilog.llm.text import mix
from vigilog.session import durable

ENTRIES_PER_PART = 1_000_000
FLUSH = 750_000
HOT_LOCAL = 1_000
HOT_MARK = 127
FINE = 8
CENTERS = 4
MORE_CENTERS = 16
LIKELY = 2
FILTER_BITS_MOST = 1 << 28
CELL_CLASSES = 512       # classes of a block of a component, about
CELL_ITEMS = 1_000_000   # elements of their sets together, about
CELL_WIDTH = 4_096
FEW = 1 << 20            # rows of ids that are broadcast rather than shuffle the sets they are joined to


# --- postings: (key, class, band) packed per part. A key takes 5 bytes in the shuffle, and a class 14 per part, however many of its keys are there

def size_band(n: np.ndarray) -> np.ndarray:
    """Size on a scale of FINE steps per factor 4/3, the smallest ratio of similar sets."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(4 / 3) * FINE + 1e-9).astype(np.int64)


def partner_limit(n: int, count: int) -> np.ndarray:
    """For each place i in a set's order, the band of the largest set with which it can be the first in common.

    All that sets of n and m have in common is then from place i on, so
    n - i >= 3/7 (n + m), which is m <= (4 n - 7 i) / 3.
    """
    most = (4 * n - 7 * np.arange(count)) // 3
    return np.where(most >= 1, size_band(most), -1)


def pack(keys: np.ndarray, classes: np.ndarray, bands: np.ndarray, limits: np.ndarray, parts: int, hot_local: int) -> pa.RecordBatch:
    """Entries as one row per part.

    Where one flush has ``hot_local`` entries on a key, they go to parts of their
    own by class, so that such a key never meets in one task; one of each band
    goes to the key's part too, for entries of other tasks to meet.
    """
    whole = keys.astype(np.int64) << 16 | bands
    order = np.argsort(whole) if limits is bands else np.lexsort((-limits, whole))
    whole, keys, classes, bands, limits = whole[order], keys[order], classes[order], bands[order], limits[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    runs = np.diff(np.r_[heads, len(keys)])
    hot = np.repeat(runs >= hot_local, runs)
    lead = np.flatnonzero(hot & np.r_[True, whole[1:] != whole[:-1]])
    spread = ((classes.view(np.uint64) >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)
    part = np.r_[np.where(hot, parts + spread, keys.astype(np.int64) % parts), keys[lead].astype(np.int64) % parts]
    order = np.argsort(np.r_[classes, classes[lead]], kind="stable")  # a class has one band, as a rule
    order = order[np.argsort(part.astype(np.uint16 if 2 * parts <= 1 << 16 else np.int64)[order], kind="stable")]
    above = (limits - bands).clip(-128, HOT_MARK - 1).astype(np.int8)
    part, keys, classes, bands = part[order], *(np.r_[x, x[lead]][order] for x in (keys, classes, bands.astype(np.uint16)))
    above = np.r_[above, np.full(len(lead), HOT_MARK, np.int8)][order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    ends = np.r_[starts[1:], len(part)]
    runs = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (classes[1:] != classes[:-1]) | (bands[1:] != bands[:-1])])
    counts = np.diff(np.r_[runs, len(part)]).astype(np.uint32)
    run_starts, run_ends = np.searchsorted(runs, starts), np.searchsorted(runs, ends)
    packed = lambda x, starts, ends: pa.array([x[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(part[starts], pa.int64()), packed(keys, starts, ends), packed(above, starts, ends),
         *(packed(x, run_starts, run_ends) for x in (classes[runs], bands[runs], counts))], POSTING_NAMES)


POSTING_NAMES = ["part", "keys", "limits", "classes", "bands", "counts"]
POSTINGS = "part long, keys binary, limits binary, classes binary, bands binary, counts binary"


def _partnered(tiles: np.ndarray, bands: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Which entries, in order of tile and band, have another one in their tile that is not above their limit."""
    if not len(tiles):
        return np.zeros(0, bool)
    head = np.r_[True, tiles[1:] != tiles[:-1]]
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    other = np.where(np.arange(len(tiles)) == first, np.minimum(first + 1, len(tiles) - 1), first)
    return (tiles[other] == tiles) & (other != np.arange(len(tiles))) & (bands[other] <= limits)


def shared_tiles(postings: DataFrame, parts: int, tags: bool = False) -> DataFrame:
    """Tiles (key and size band) with classes that can be similar: ``tile``, ``cls``.

    With ``tags`` the bands are tags of documents, not sizes: a tile is a key, and one of a single document is left out.

    A class is in its own band and the next, so that classes of one or of two
    neighbouring bands meet. A tile is named by its classes: the shingles of one
    passage make the same tile, once. A tile that is spread over parts is named by its key.
    """
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(pdf["keys"]), np.uint32).astype(np.int64)
        counts = np.frombuffer(b"".join(pdf["counts"]), np.uint32)
        classes = np.repeat(np.frombuffer(b"".join(pdf["classes"]), np.int64), counts)
        bands = np.repeat(np.frombuffer(b"".join(pdf["bands"]), np.uint16).astype(np.int64), counts)
        limits = bands + np.frombuffer(b"".join(pdf["limits"]), np.int8)
        own = pdf["part"].iloc[0] < parts  # not one of the spread parts
        if own:  # most keys have one class: drop those first
            order = np.argsort(keys, kind="stable")
            keys, classes, bands, limits = keys[order], classes[order], bands[order], limits[order]
            same = keys[1:] == keys[:-1]
            keep = np.r_[same, False] | np.r_[False, same]
            keys, classes, bands, limits = keys[keep], classes[keep], bands[keep], limits[keep]
        if tags:
            tiles = keys << 8
        else:
            tiles = np.r_[keys << 8 | bands // FINE, keys << 8 | bands // FINE + 1]
            classes, bands, limits = np.r_[classes, classes], np.r_[bands, bands], np.r_[limits, limits]
        order = np.lexsort((-limits, classes, bands, tiles))  # of equal classes the one with the mark, or the largest limit, stays
        tiles, classes, bands, limits = tiles[order], classes[order], bands[order], limits[order]
        if tags and own and len(tiles):  # in order of tag: the first and the last differ
            head = np.r_[True, tiles[1:] != tiles[:-1]]
            first = np.flatnonzero(head)
            last = np.r_[first[1:], len(tiles)] - 1
            several = (bands[first] != bands[last]) | np.isin(tiles[first], tiles[limits - bands == HOT_MARK])
            keep = np.repeat(several, last - first + 1)
            tiles, classes, bands, limits = tiles[keep], classes[keep], bands[keep], limits[keep]
            order = np.lexsort((classes, tiles))
            tiles, classes, bands, limits = tiles[order], classes[order], bands[order], limits[order]
        marked = np.unique(tiles[limits - bands == HOT_MARK])
        fresh = np.r_[True, (tiles[1:] != tiles[:-1]) | (classes[1:] != classes[:-1])][:len(tiles)]
        tiles, classes, bands, limits = tiles[fresh], classes[fresh], bands[fresh], limits[fresh]
        for _ in range(2 * (own and not tags)):
            keep = _partnered(tiles, bands, limits)
            tiles, classes, bands, limits = tiles[keep], classes[keep], bands[keep], limits[keep]
        heads = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1]][:len(tiles)])
        runs = np.diff(np.r_[heads, len(tiles)])
        if own and len(tiles):
            names = mix(np.add.reduceat(mix(classes.view(np.uint64)), heads) + runs.astype(np.uint64))
            names = np.where(np.isin(tiles[heads], marked), mix(tiles[heads].view(np.uint64)), names)
        else:
            names = mix(tiles[heads].view(np.uint64))
        return pd.DataFrame({"tile": np.repeat(names, runs).view(np.int64), "cls": classes})

    return postings.groupBy("part").applyInPandas(meet, "tile long, cls long").distinct()


# --- a membership filter of bounded size for classes

def class_filter(classes: DataFrame) -> np.ndarray:
    """Bits of the numbers in the only column, for a cheap first test; they may be set by chance, never missing.

    Sixteen bits a number, three of them set: one in 200 others passes by chance. FILTER_BITS_MOST (32 MB) at most;
    beyond that it only lets more through.
    """
    count = classes.count()
    bits = 1 << 16
    while bits < min(16 * count, FILTER_BITS_MOST):
        bits <<= 1
    block = 1 << 16

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(np.concatenate(_places_of(batch.column(0).to_numpy(zero_copy_only=False), bits)))
            numbers, starts = np.unique(at // block, return_index=True)
            for number, places in zip(numbers.tolist(), np.split(at % block, starts[1:])):
                mine.setdefault(number, np.zeros(block, np.uint8))[places] = 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(mine), pa.int64()), pa.array([np.packbits(x).tobytes() for x in mine.values()], pa.binary())],
            ["block", "bits"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["bits"].iloc[0], np.uint8).copy()
        for other in pdf["bits"].iloc[1:]:
            total |= np.frombuffer(other, np.uint8)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "bits": [total.tobytes()]})

    blocks = classes.mapInArrow(local, "block long, bits binary") \
        .groupBy("block").applyInPandas(join, "block long, bits binary")
    total = np.zeros(bits // 8, np.uint8)
    for row in blocks.collect():  # 32 MB at most
        total[row["block"] * block // 8:(row["block"] + 1) * block // 8] = np.frombuffer(row["bits"], np.uint8)
    return total


def _places_of(classes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of three bits of each class."""
    mixed = mix(classes.view(np.uint64))
    return [((mixed >> np.uint64(shift)) % np.uint64(bits)).astype(np.int64) for shift in (0, 18, 36)]


def may_have(bits: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Which classes pass the filter."""
    found = np.ones(len(classes), bool)
    for at in _places_of(classes, len(bits) * 8):
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return found


def among(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted classes (``cls``) and of few others, filtered where they are read, before any shuffle."""
    bits = table.sparkSession.sparkContext.broadcast(class_filter(wanted))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_have(bits.value, batch.column("cls").to_numpy(zero_copy_only=False))))

    return table.mapInArrow(pick, table.schema)


def picked(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls`` and ``items`` of the wanted classes and of few others."""
    return among(contents.select("cls", "items"), wanted)


def few(ids: DataFrame) -> DataFrame:
    """``ids`` as the side of a join that is broadcast, if it has FEW rows at most."""
    return F.broadcast(ids) if ids.count() <= FEW else ids


def repeated(table: DataFrame, parts: int) -> DataFrame:
    """``cls`` that has several rows in the table. Eight bytes a class are shuffled, and two of each at most from one flush."""
    most = FLUSH  # as the driver has it

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= most:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def flush(held: list) -> pa.RecordBatch:
        classes = np.sort(np.concatenate(held))
        classes = classes[np.r_[[True] * min(2, len(classes)), classes[2:] != classes[:-2]]]
        part = ((classes.view(np.uint64) >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        numbers, starts = np.unique(part[order], return_index=True)
        pieces = np.split(classes[order], starts[1:])
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array([x.tobytes() for x in pieces], pa.binary())], ["part", "classes"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        classes = np.sort(np.frombuffer(b"".join(pdf["classes"]), np.int64))
        return pd.DataFrame({"cls": np.unique(classes[1:][classes[1:] == classes[:-1]])})

    return table.select("cls").mapInArrow(pack, "part long, classes binary").groupBy("part").applyInPandas(meet, "cls long")


# --- links

def overlap_bound(n: Column, bits: Column, other_bits: Column) -> Column:
    """Most elements a set can have in common with another: each bit the other lacks is an element it lacks.

    Lengths are powers of two; the longer bitmap is folded onto the shorter.
    """
    lacking = F.aggregate(F.zip_with(_fold(bits, other_bits), _fold(other_bits, bits),
                                     lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
                          F.lit(0), lambda total, x: total + x)
    return n - lacking


def _fold(bits: Column, other: Column) -> Column:
    """``bits`` once folded if longer than ``other``; sizes in a ratio up to 4/3 differ by one doubling at most."""
    half = F.size(other)
    folded = F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseOR(y))
    return F.when(F.size(bits) > half, folded).otherwise(bits)


def _most(left: str, right: str) -> Column:
    """Most elements in common of two marks, by both bitmaps."""
    return F.least(overlap_bound(F.col(f"{left}.n"), F.col(f"{left}.bits"), F.col(f"{right}.bits")),
                   overlap_bound(F.col(f"{right}.n"), F.col(f"{right}.bits"), F.col(f"{left}.bits")))


def _possible(left: str, right: str) -> Column:
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    return F.when(4 * F.least(n, m) >= 3 * F.greatest(n, m), 7 * _most(left, right) >= 3 * (n + m)).otherwise(False)


def _share(left: str, right: str) -> Column:
    """How similar two marks look: the bound against both sizes."""
    return (_most(left, right) / (F.col(f"{left}.n") + F.col(f"{right}.n"))).alias("share")


def _apart(marks: DataFrame) -> Column:
    """Where marks name a row of each class, classes of one row are not compared."""
    return F.col("x.row") != F.col("y.row") if "row" in marks.columns else F.lit(True)


Fetch = Callable[[DataFrame], DataFrame]


def bounded(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The distinct pairs ``a``, ``b`` that the bounds let pass, with ``share``."""
    return pairs.select("a", "b").distinct() \
        .join(marks.alias("x"), F.col("a") == F.col("x.cls")).join(marks.alias("y"), F.col("b") == F.col("y.cls")) \
        .where(_apart(marks) & _possible("x", "y")).select("a", "b", _share("x", "y"))


def verify(pruned: DataFrame, fetch: Fetch) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar. Only sets of these pairs are fetched."""
    items = fetch(pruned.select(F.col("a").alias("cls")).union(pruned.select("b")).distinct())
    sets = pruned.join(items.alias("x"), F.col("a") == F.col("x.cls")) \
        .join(items.alias("y"), F.col("b") == F.col("y.cls")) \
        .select("a", "b", F.col("x.items").alias("s"), F.col("y.items").alias("t"))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                s, t = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                keep.append(7 * int((t[at] == s).sum()) >= 3 * (len(s) + len(t)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sets.mapInArrow(exact, "a long, b long")


def _likely(pairs: DataFrame, marks: DataFrame, fetch: Fetch) -> DataFrame:
    """Similar pairs among the LIKELY best bounded of each ``b``."""
    best = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("share"), "a"))
    chosen = bounded(pairs, marks).withColumn("rank", best).where(F.col("rank") <= LIKELY).select("a", "b")
    return durable(verify(durable(chosen, "pairs"), fetch), "star")


def _labelled(tiles: DataFrame, known: DataFrame) -> DataFrame:
    """Classes of tiles with more than one component: ``tile``, ``cls``, ``comp``, ``major`` (the tile's largest)."""
    labelled = tiles.join(known, F.col("cls") == F.col("node"), "left") \
        .select("tile", "cls", F.coalesce("root", "cls").alias("comp"))
    mixed = labelled.groupBy("tile", "comp").count().groupBy("tile") \
        .agg(F.max(F.struct("count", "comp")).getField("comp").alias("major"), F.count("*").alias("k")) \
        .where("k > 1").drop("k")
    return labelled.join(mixed, "tile")


def link(tiles: DataFrame, marks: DataFrame, fetch: Fetch) -> DataFrame:
    """Components of similar classes that share a tile: ``node``, ``root``; classes without a link are absent.

    First every class of a tile is bounded against its smallest ones and checked
    with the LIKELY most similar; then those outside the tile's largest
    component against more, from the other end. Both are linear in the size of
    a tile, and enough for most groups of near copies. At last only classes of one
    tile in different components are compared, those outside its largest
    component with all others, so that no similar pair is missed and no group of
    copies is multiplied out.
    """
    smallest = F.row_number().over(Window.partitionBy("tile").orderBy("cls"))
    centers = tiles.withColumn("rank", smallest).where(F.col("rank") <= CENTERS).select("tile", F.col("cls").alias("a"))
    star = tiles.join(centers, "tile").where("cls <> a").select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
    known = durable(components(_likely(star, marks, fetch)), "known")

    rows = durable(_labelled(tiles, known), "mixed")
    largest = F.row_number().over(Window.partitionBy("tile").orderBy(F.desc("cls")))
    others = rows.withColumn("rank", largest).where(F.col("rank") <= MORE_CENTERS).select("tile", F.col("cls").alias("a"), F.col("comp").alias("other"))
    star = rows.where("comp <> major").join(others, "tile").where("comp <> other").select("a", F.col("cls").alias("b"))
    known = durable(_joined(known, _likely(star, marks, fetch)), "known")

    rows = durable(_labelled(rows.select("tile", "cls"), known).join(marks, "cls"), "mixed")
    near = rows.alias("x").join(
        rows.where("comp <> major").alias("y"),
        (F.col("x.tile") == F.col("y.tile")) & (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("x.comp") == F.col("x.major")) | (F.col("x.cls") < F.col("y.cls"))) & _apart(marks) & _possible("x", "y")) \
        .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
    return _joined(known, verify(durable(near.distinct(), "pairs"), fetch))


def cells(linked: DataFrame, marks: DataFrame, fetch: Fetch) -> DataFrame:
    """The comparisons of all classes of each component (``linked`` as by ``link``; ``fetch`` keeps the columns it gets): ``cls``, ``items``, in a cell named by
    ``root``, ``i``, ``j``; ``right`` says that the class is of block j, not i.

    A component's classes are dealt to blocks of some CELL_CLASSES classes and CELL_ITEMS elements, and two blocks, or
    one with itself, are a cell. Any two classes of a component meet in one cell, so a group of k classes takes
    k * ceil(k / CELL_CLASSES) rows, not k * k. Most components are one block.
    """
    sized = linked.join(marks.select("cls", "n"), F.col("node") == F.col("cls")).select("cls", "root", "n")
    blocks = sized.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / CELL_CLASSES, F.sum("n") / CELL_ITEMS)).cast("long").alias("blocks"))
    placed = durable(sized.join(blocks, "root").select("cls", "root", "blocks", F.expr("pmod(xxhash64(cls), blocks)").alias("block")), "placed")
    return fetch(placed) \
        .select("cls", "root", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"), "items") \
        .select("cls", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                (F.col("block") > F.col("other")).alias("right"), "items")


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``left`` and ``right`` (of ``left`` and itself, if there is no ``right``) are similar, as a table.

    Elements of one set alone don't count; the others make rows of zeros and ones whose products are the sizes of intersections.
    """
    sets = [*left, *right]
    sizes = np.array([len(x) for x in sets])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    keep = shared[at]
    row, column = np.repeat(np.arange(len(sets)), sizes)[keep], (np.cumsum(shared) - 1)[at[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    others = slice(len(left), None) if right else slice(None)
    common = np.zeros((len(left), len(sizes[others])), np.int64)
    width = int(min(CELL_WIDTH, shared.sum()))
    for start in range(0, int(shared.sum()), width or 1):
        mine = slice(*np.searchsorted(column, [start, start + width]))
        table = np.zeros((len(sets), width), np.float32)  # sums up to CELL_WIDTH are exact
        table[row[mine], column[mine] - start] = 1
        common += (table[:len(left)] @ table[others].T).astype(np.int64)
    similar = 7 * common >= 3 * (sizes[:len(left), None] + sizes[others])
    if not right:
        np.fill_diagonal(similar, False)
    return similar


def _compared(found: DataFrame, schema: str, result: Callable[..., list[np.ndarray]]) -> DataFrame:
    """``result`` of the classes of both sides and the table of the similar ones, for each cell."""
    names = [x.split()[0] for x in schema.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [], [], [])
        for batch in batches:
            out = []
            for *now, cls, right, items in zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "cls", "right")), batch.column("items")):
                if now != key:
                    out += cell(key, held)
                    key, held = now, ([], [], [], [])
                held[2 * right].append(cls)
                held[2 * right + 1].append(np.frombuffer(items.as_buffer(), np.uint64))
            yield rows(out)
        yield rows(cell(key, held))

    def cell(key: list | None, held: tuple) -> list[list[np.ndarray]]:
        left, sets, right, others = held
        if not left or len(left) + len(right) < 2 or (key[1] != key[2] and not right):  # nothing to compare
            return []
        table = similar_pairs(sets, others)
        return [result(np.array(left, np.int64), np.array(right or left, np.int64), table, bool(right))]

    def rows(out: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *x])) for x in (zip(*out) if out else [()] * 2)], names)

    return found.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(compare, schema)


def link_counts(found: DataFrame) -> DataFrame:
    """Exact number of links of each class of the cells: ``cls``, ``links``."""
    def count(left: np.ndarray, right: np.ndarray, table: np.ndarray, two: bool) -> list[np.ndarray]:
        if not two:
            return [left, table.sum(axis=1)]
        return [np.r_[left, right], np.r_[table.sum(axis=1), table.sum(axis=0)]]

    return _compared(found, "cls long, links long", count).groupBy("cls").agg(F.sum("links").alias("links"))


def all_links(found: DataFrame) -> DataFrame:
    """Every pair ``a`` < ``b`` of similar classes of the cells, once. As many rows as there are links."""
    def pairs(left: np.ndarray, right: np.ndarray, table: np.ndarray, two: bool) -> list[np.ndarray]:
        i, j = np.nonzero(table if two else np.triu(table))
        return [np.minimum(left[i], right[j]), np.maximum(left[i], right[j])]

    return _compared(found, "a long, b long", pairs)


def _joined(known: DataFrame, more: DataFrame) -> DataFrame:
    """Components of components and further links; without any, no round is run."""
    more = durable(more, "more")
    if more.isEmpty():
        return known
    return components(known.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
