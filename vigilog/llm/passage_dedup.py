"""Passages that repeat across documents."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm import similarity
from vigilog.llm.text import SHINGLE, bitmap, input_columns, line_words, mix, positions, raw
from vigilog.session import durable

LENGTH = 30          # words of a window
SPACING = 22         # any run of LENGTH + SPACING - 1 = 51 words holds a whole window of its own
LEAST = 6            # words of a paragraph: two shingles
LONG = 100           # longer paragraphs have segments too
CUT = 32             # a segment begins where a hash is the least of as many places before and after
WRAPPED = 25         # words of a line, at most, in a text whose lines may be one paragraph
BANDS, ROWS = 12, 3  # of paragraphs and segments. At similarity 0.75: 1 - (1 - 0.75**3)**12 = 0.9986 of pairs collide; equal units always do
MARGIN = SPACING - 1  # the first and last window of a repeated passage lie at most so many words inside it
PARAGRAPH, SEGMENT, WINDOW = range(3)
_SHINGLES = LENGTH - SHINGLE + 1
_CHUNK_WORDS = 300_000
PAIR_WORDS = 4_000_000  # words compared at once
_SEEDS = [np.uint64(pow(0xA3EC647659359ACD, j + 1, 1 << 64) | 1) for j in range(BANDS * ROWS)]
_BASE = 0xD1342543DE82EF95
_BASE_BACK = pow(_BASE, -1, 1 << 64)


def _slide(x: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """Least (or best) of each window of so many entries."""
    out, done = x, 1
    while done < width:
        step = min(done, width - done)
        out = best(out[:-step], out[step:])
        done += step
    return out


class Units(NamedTuple):
    """Units of many texts: text number, first word in it, words, words after it, kind, place in the hashes of all words and shingles."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    after: np.ndarray
    kind: np.ndarray
    at: np.ndarray
    words: np.ndarray
    shingles: np.ndarray

    def classes(self) -> np.ndarray:
        """One number for the words of each unit in their order."""
        n = len(self.words)
        powers, back = (np.cumprod(np.r_[np.uint64(1), np.full(n, x, np.uint64)]) for x in (_BASE, _BASE_BACK))
        total = np.r_[np.uint64(0), np.cumsum(self.words * powers[:-1])]
        value = (total[self.at + self.length] - total[self.at]) * back[self.at]
        return mix(value + mix(self.length.astype(np.uint64))).view(np.int64)

    def set_of(self, i: int) -> np.ndarray:
        return np.unique(self.shingles[self.at[i]:self.at[i] + self.length[i] - SHINGLE + 1])

    def pick(self, chosen: np.ndarray) -> Units:
        return Units(*(x[chosen] for x in self[:6]), self.words, self.shingles)


def units(texts: list) -> Units:
    """Windows, paragraphs and segments of many texts.

    A window is LENGTH words from a place whose shingle hash is the least of some
    SPACING places in a row, so equal passages choose equal places wherever
    they stand, in a line or across lines. Paragraphs are lines, and blocks of
    lines between blank ones (without blank ones the whole text, where
    its lines are wrapped), of LEAST words or more. Those of more than LONG words are also cut into
    segments, at places whose shingle hash is the least within CUT words, so
    that near copies inside of long ones have nearly the same segments.
    """
    in_text, sizes, hashes = line_words(texts)
    counts = np.bincount(in_text, sizes, len(texts)).astype(np.int64)
    if len(hashes) < LENGTH + SPACING - 1:
        hashes = np.r_[hashes, np.zeros(LENGTH + SPACING, np.uint64)]
    all_ = positions(hashes)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(text)) - first[text]
    valid = np.zeros(len(all_), bool)
    valid[np.flatnonzero(place + LENGTH <= counts[text])] = True
    rank = np.where(valid, all_, np.uint64(0xFFFFFFFFFFFFFFFF))
    windows = np.flatnonzero(_chosen(rank, SPACING) & valid)

    begin, size = _paragraphs(in_text, sizes, counts)
    begin, size = begin[size >= LEAST], size[size >= LEAST]
    lead, rest = _segments(begin[size > LONG], size[size > LONG], rank, valid)
    at = np.r_[begin, lead, windows].astype(np.int64)
    length = np.r_[size, rest, np.full(len(windows), LENGTH)].astype(np.int64)
    kind = np.repeat([PARAGRAPH, SEGMENT, WINDOW], [len(begin), len(lead), len(windows)])
    once = np.sort(np.unique(at << 32 | length, return_index=True)[1])
    at, length, kind = at[once], length[once], kind[once]
    return Units(text[at], place[at], length, counts[text[at]] - place[at] - length, kind, at, hashes, all_)


def _chosen(rank: np.ndarray, width: int) -> np.ndarray:
    """Which places are the least of some ``width`` places in a row."""
    least = _slide(rank, width)
    edge = np.zeros(width - 1, np.uint64)
    return _slide(np.r_[edge, least, edge], width, np.maximum) == rank


def _paragraphs(in_text: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each line and of each block of several lines."""
    begin = np.cumsum(sizes) - sizes
    full = np.flatnonzero(sizes)
    if not len(full):
        return begin[full], sizes[full]
    fresh = np.r_[True, (np.diff(full) > 1) | (np.diff(in_text[full]) > 0)]
    heads = np.flatnonzero(fresh)
    blocks = np.add.reduceat(sizes[full], heads)
    several = np.diff(np.r_[heads, len(full)]) > 1
    wrapped = np.maximum.reduceat(sizes[full], heads) <= WRAPPED
    taken = several & (wrapped | (blocks < counts[in_text[full[heads]]]))
    return np.r_[begin[full], begin[full[heads[taken]]]], np.r_[sizes[full], blocks[taken]]


def _segments(begin: np.ndarray, size: np.ndarray, rank: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of the segments of long paragraphs."""
    if not len(begin):
        return begin, size
    most = np.full(CUT, 0xFFFFFFFFFFFFFFFF, np.uint64)
    cuts = np.flatnonzero((_slide(np.r_[most, rank, most], 2 * CUT + 1) == rank) & valid)
    left, right = np.searchsorted(cuts, begin, "right"), np.searchsorted(cuts, begin + size)
    edges = [np.r_[b, cuts[i:j], b + n] for b, n, i, j in zip(begin, size, left, right)]
    lead, rest = np.concatenate([x[:-1] for x in edges]), np.concatenate([np.diff(x) for x in edges])
    return lead[rest >= LEAST], rest[rest >= LEAST]


def _top_of_mix(x: np.ndarray, seed: np.uint64, out: np.ndarray, moved: np.ndarray) -> None:
    """``mix(x * seed) >> 32`` without arrays of its own; the last step of ``mix`` leaves these bits as they are."""
    np.multiply(x, seed, out=out)
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        np.right_shift(out, np.uint64(shift), out=moved)
        np.bitwise_xor(out, moved, out=out)
        np.multiply(out, np.uint64(factor), out=out)
    np.right_shift(out, np.uint64(32), out=out)


def band_keys(found: Units) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """MinHash of the shingles of paragraphs and segments, ROWS at a time, as 32-bit keys, with the numbers of their units.

    Windows have none: equal ones are one class, and two that differ are hardly
    ever similar, as one changed word breaks up to five of their 26 shingles.
    """
    mine = np.flatnonzero(found.kind != WINDOW)
    if not len(mine):
        return
    # In the order of the text, or what lies between two units would be gone over for every unit.
    mine = mine[np.argsort(found.at[mine], kind="stable")]
    ends = np.column_stack([found.at[mine], found.at[mine] + found.length[mine] - SHINGLE + 1]).ravel()
    hashed, moved = np.zeros(len(found.shingles) + 1, np.uint64), np.empty(len(found.shingles), np.uint64)
    for b in range(BANDS):
        key = np.full(len(mine), b + 1, np.uint64)
        for seed in _SEEDS[b * ROWS:(b + 1) * ROWS]:
            _top_of_mix(found.shingles, seed, hashed[:-1], moved)
            key = mix(key + np.minimum.reduceat(hashed, ends)[::2])
        yield (key >> np.uint64(32)).astype(np.uint32), mine


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Rows, ids and texts of some hundred thousand words at a time."""
    rows, ids, texts, size = [], [], [], 0
    for batch in batches:
        for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
            rows.append(row)
            ids.append(doc_id)
            texts.append(text)
            size += len(text or b"") // 6
            if size >= _CHUNK_WORDS:
                yield rows, ids, texts
                rows, ids, texts, size = [], [], [], 0
    if rows:
        yield rows, ids, texts


def _places(docs: DataFrame) -> DataFrame:
    """Every unit at every place: ``row``, ``doc_id``, ``cls``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, texts in _chunks(batches):
            found = units(texts)
            cls = found.classes()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(rows, np.int64)[found.text]), pa.array(ids, pa.int64()).take(pa.array(found.text)), pa.array(cls)],
                ["row", "doc_id", "cls"])

    return docs.mapInArrow(place, "row long, doc_id long, cls long")


def _postings(docs: DataFrame, parts: int) -> DataFrame:
    """Band keys of the distinct units of a task, with a tag of the document."""
    most, hot_local = similarity.FLUSH, similarity.HOT_LOCAL  # as the driver has them

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, np.empty(0, np.int64)
        for rows, _, texts in _chunks(batches):
            found = units(texts)
            classes, banded = found.classes(), np.flatnonzero(found.kind != WINDOW)
            cls, pick = np.unique(classes[banded], return_index=True)
            fresh = ~np.isin(cls, seen)
            cls, pick = cls[fresh], pick[fresh]
            seen = np.r_[seen, cls]
            found = found.pick(banded[pick])
            tags = (mix(np.array(rows, np.int64).view(np.uint64)) & np.uint64(0xFFFF)).astype(np.int64)[found.text]
            for key, mine in band_keys(found):
                held.append((key, cls[mine], tags[mine]))
                size += len(mine)
            if size >= most:
                yield flush(held)
                held, size, seen = [], 0, np.empty(0, np.int64)
        if size:
            yield flush(held)

    def flush(held: list) -> pa.RecordBatch:
        keys, classes, tags = map(np.concatenate, zip(*held))
        return similarity.pack(keys, classes, tags, tags, parts, hot_local)

    return docs.mapInArrow(post, similarity.POSTINGS)


def _contents(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Shingle sets of the chosen units (``cls``, ``row``, each ``cls`` once), from one row each.

    A row's texts are in one chunk, so a set comes from it once and is shuffled once.
    """
    spark = docs.sparkSession
    rows_wanted = spark.sparkContext.broadcast(similarity.class_filter(chosen.select("row").distinct()))
    wanted = spark.sparkContext.broadcast(similarity.class_filter(chosen.select("cls")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = (batch.filter(pa.array(similarity.may_have(rows_wanted.value, batch.column("row").to_numpy(zero_copy_only=False))))
                for batch in batches)
        for rows, _, texts in _chunks(mine):
            found = units(texts)
            classes = found.classes()
            picked = np.flatnonzero(similarity.may_have(wanted.value, classes))
            _, once = np.unique(np.stack([found.text[picked], classes[picked]]), axis=1, return_index=True)
            picked = picked[np.sort(once)]
            sets = [found.set_of(i) for i in picked.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(rows, np.int64)[found.text[picked]]), pa.array(classes[picked]), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([bitmap(x) for x in sets], pa.list_(pa.int64())), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["row", "cls", "n", "bits", "items"])

    found = docs.mapInArrow(fetch, "row long, cls long, n long, bits array<long>, items binary")
    return found.join(chosen, ["row", "cls"], "left_semi")


def _place_of(cls: Column, row: Column) -> Column:
    """One number for a class in a row."""
    return cls.bitwiseXOR(F.shiftleft(row, 7))


def _spots(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every place of the chosen classes, perhaps of a few others, with its words and up to MARGIN around them as 32-bit
    hashes: ``row``, ``doc_id``, ``start``, ``length``, ``left_out``, ``kind``, ``cls``, ``lead`` (words before it), ``words``.

    A class that is linked to no other (not ``links``) has the same words in all places, so its number stands for them:
    ``length`` is then 2, and ``left_out`` so many words more. A paragraph that does not stay is removed as a whole, without words.
    """
    share = docs.sparkSession.sparkContext.broadcast
    wanted = share(similarity.class_filter(chosen.select("cls")))
    linked = share(similarity.class_filter(chosen.where("links").select("cls")))
    stays = share(similarity.class_filter(chosen.select(_place_of(F.col("cls"), F.col("keep_row")))))

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, texts in _chunks(batches):
            found = units(texts)
            classes = found.classes()
            picked = np.flatnonzero(similarity.may_have(wanted.value, classes))
            found, classes = found.pick(picked), classes[picked]
            row = np.array(rows, np.int64)[found.text]
            short = (found.words >> np.uint64(32)).astype(np.uint32)
            bare = (found.kind == PARAGRAPH) & ~similarity.may_have(stays.value, classes ^ (row << 7))
            lead, tail = (np.where(bare, 0, np.minimum(x, MARGIN)) for x in (found.start, found.after))
            alone = ~similarity.may_have(linked.value, classes)
            length = np.where(bare, 0, np.where(alone, 2, found.length))
            words = _cut(short, classes.view(np.uint32), found.at, found.length, lead, tail, alone, bare)
            yield pa.RecordBatch.from_arrays([
                pa.array(row), pa.array(ids, pa.int64()).take(pa.array(found.text)),
                *(pa.array(x.astype(np.int32)) for x in (found.start, length, found.length - length, found.kind)), pa.array(classes), pa.array(lead.astype(np.int32)),
                pa.array(words, pa.binary())], ["row", "doc_id", "start", "length", "left_out", "kind", "cls", "lead", "words"])

    return docs.mapInArrow(spot, "row long, doc_id long, start int, length int, left_out int, kind int, cls long, lead int, words binary")


def _cut(words: np.ndarray, names: np.ndarray, at: np.ndarray, length: np.ndarray, lead: np.ndarray, tail: np.ndarray, alone: np.ndarray, bare: np.ndarray) -> list:
    """Bytes of the words of units and around them; units that are alone have their two numbers instead, bare ones nothing."""
    out = []
    for k, (i, n, before, after, one, none) in enumerate(zip(*(x.tolist() for x in (at, length, lead, tail, alone, bare)))):
        if none:
            out.append(b"")
        elif one:
            out.append(words[i - before:i].tobytes() + names[2 * k:2 * k + 2].tobytes() + words[i + n:i + n + after].tobytes())
        else:
            out.append(words[i - before:i + n + after].tobytes())
    return out


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many first entries are equal."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def shared_span(words: np.ndarray, lead: int, length: int, kept: list[tuple[np.ndarray, int, int]]) -> tuple[int, int]:
    """First and last word, counted from the unit's first, that it shares with the kept places.

    From the first to the last common shingle, and on to both sides as long as words are equal.
    Without a common shingle (similar by others of the group only) it is the unit.
    """
    low, high, here = None, None, None
    mine = words[lead:lead + length]
    for other, other_lead, other_length in kept:
        if other_length == length and (other[other_lead:other_lead + length] == mine).all():
            pairs = [(lead, other_lead)]
            last = [(lead + length, other_lead + length)]
        else:
            here = positions(mine.astype(np.uint64)) if here is None else here
            there = positions(other.astype(np.uint64))
            common = np.flatnonzero(np.isin(here, there))
            if not len(common):
                continue
            pairs = [(lead + common[0], j) for j in np.flatnonzero(there == here[common[0]])]
            last = [(lead + common[-1] + SHINGLE, j + SHINGLE) for j in np.flatnonzero(there == here[common[-1]])]
        left = min(i - _equal(words[:i][::-1], other[:j][::-1]) for i, j in pairs) - lead
        right = max(i + _equal(words[i:], other[j:]) for i, j in last) - lead
        low, high = left if low is None else min(low, left), right if high is None else max(high, right)
    return (0, length) if low is None else (int(low), int(high))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words of a column of packed words, and where each row's begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64) // 4
    return np.frombuffer(column.buffers()[2], np.uint32, offsets[-1]), offsets[:-1]


def _run(words: np.ndarray, at: np.ndarray, other: np.ndarray, there: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from each place on (back, with step -1) are equal, MARGIN or ``room`` at most."""
    ahead = np.arange(MARGIN)
    mine = words[np.clip(at[:, None] + step * ahead, 0, len(words) - 1)]
    same = (mine == other[np.clip(there[:, None] + step * ahead, 0, len(other) - 1)]) & (ahead < room[:, None])
    return np.logical_and.accumulate(same, axis=1).sum(axis=1)


def _spans(batch: pa.RecordBatch, _: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``shared_span`` of each row, of all rows at once: places of the same words first, then the others by their common shingles."""
    words, begin = _flat(batch.column("words"))
    lead, length = (batch.column(c).to_numpy().astype(np.int64) for c in ("lead", "length"))
    size = np.diff(np.r_[begin, len(words)])
    counts = np.diff(batch.column("kept").offsets.to_numpy().astype(np.int64))
    other_lead, other_length, packed = batch.column("kept").flatten().flatten()
    others, there = _flat(packed)
    other_size = np.diff(np.r_[there, len(others)])
    other_lead, other_length = (x.to_numpy().astype(np.int64) for x in (other_lead, other_length))
    row = np.repeat(np.arange(len(counts)), counts)
    same = length[row] == other_length
    pairs = np.flatnonzero(same)
    for some in np.array_split(pairs, int(length[row[pairs]].sum()) // PAIR_WORDS + 1):
        if len(some):
            n = length[row[some]]
            first = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(first, n)
            mine, its = (begin + lead)[row[some]], (there + other_lead)[some]
            same[some] = np.logical_and.reduceat(words[np.repeat(mine, n) + step] == others[np.repeat(its, n) + step], first)
    low, high = np.full(len(counts), np.iinfo(np.int64).max), np.full(len(counts), -1)
    pairs = np.flatnonzero(same)
    for some in np.array_split(pairs, len(pairs) * MARGIN // PAIR_WORDS + 1):
        i, mine, its = row[some], (begin + lead)[row[some]], (there + other_lead)[some]
        left = _run(words, mine - 1, others, its - 1, np.minimum(lead[i], other_lead[some]), -1)
        rest = np.minimum((size - lead - length)[i], (other_size - other_lead - other_length)[some])
        right = _run(words, mine + length[i], others, its + length[i], rest, 1)
        np.minimum.at(low, i, -left)
        np.maximum.at(high, i, length[i] + right)
    pairs = np.flatnonzero(~same)
    if len(pairs):
        mine_all, their_all = positions(words.astype(np.uint64)), positions(others.astype(np.uint64))
        sizes = length[row[pairs]] + other_size[pairs]
        for some in np.split(pairs, np.flatnonzero(np.diff(np.cumsum(sizes) // PAIR_WORDS)) + 1):
            i, mine = row[some], (begin + lead)[row[some]]
            pair, place = _each(length[i] - SHINGLE + 1)
            other, there_at = _each(other_size[some] - SHINGLE + 1)
            keys = mix(mine_all[mine[pair] + place] ^ mix(pair.astype(np.uint64)))
            theirs = mix(their_all[there[some][other] + there_at] ^ mix(other.astype(np.uint64)))
            order = np.argsort(theirs)
            theirs = theirs[order]
            common = np.flatnonzero(theirs[np.minimum(np.searchsorted(theirs, keys), len(theirs) - 1)] == keys)
            for step, ends in ((-1, np.r_[True, np.diff(pair[common]) > 0]), (1, np.r_[np.diff(pair[common]) > 0, True])):
                at = common[ends[:len(common)]]
                low_at = np.searchsorted(theirs, keys[at])
                which, rank = _each(np.searchsorted(theirs, keys[at], "right") - low_at)
                at, j = at[which], there_at[order[low_at[which] + rank]]
                own, from_, its = i[pair[at]], place[at], some[pair[at]]
                # Only at an edge of the unit can words beyond the shingle be equal, else it were not the first or last one.
                if step < 0:
                    room = np.where(from_ == 0, np.minimum(lead[own], j), 0)
                    np.minimum.at(low, own, from_ - _run(words, mine[pair[at]] + from_ - 1, others, there[its] + j - 1, room, -1))
                else:
                    from_, j = from_ + SHINGLE, j + SHINGLE
                    room = np.where(from_ == length[own], np.minimum((size - lead - length)[own], other_size[its] - j), 0)
                    np.maximum.at(high, own, from_ + _run(words, mine[pair[at]] + from_, others, there[its] + j, room, 1))
    none = high < 0
    low[none], high[none] = 0, length[none]
    return low, high


def _each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0 .. count - 1 for each count, and which count it is of."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - (np.cumsum(counts) - counts)[which]


def _fitted(removed: DataFrame, kept: DataFrame) -> DataFrame:
    """Windows and segments to remove with ``start`` and ``end`` of what they share with the kept document."""
    names = [c for c in removed.columns if c not in ("start", "length", "left_out", "kind", "lead", "words")]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in removed.select(names).schema.fields)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            start, left_out = batch.column("start").to_numpy(), batch.column("left_out").to_numpy()
            low, high = _spans(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array((start + low).astype(np.int32)), pa.array((start + left_out + high).astype(np.int32))],
                                             [*names, "start", "end"])

    return removed.join(kept, "group_id").mapInArrow(fit, f"{fields}, start int, end int")


def repeats(docs: DataFrame) -> DataFrame:
    """Repeated passages, one row per place and the place that stays: ``doc_id``, ``row``, ``start``, ``end`` (words),
    ``group_id``, ``group_size``, ``keep_id``, ``removed``.

    Two passages repeat each other when the Jaccard similarity of their
    five-word shingles is 0.75 or more. Passages are paragraphs of six words or
    more (lines, blocks between blank lines), segments of long ones, and windows
    of 30 words: any 51 words in a row that stand in
    two documents are found, in a line or across lines. What one text alone repeats is left. Of each
    component of passages, counted at every place, those of the first document (by doc_id, null last, then row) stay; the others are removed:
    paragraphs as a whole, of windows and segments what they share with the kept document, up to where words differ. Texts under six words, null and empty ones have no
    passage. Repeated rows repeat all their passages. Other columns are not read.
    """
    docs = input_columns(docs).select("*", F.monotonically_increasing_id().alias("row"))
    places = durable(_places(docs), "places")
    entries = places.count() * BANDS // 3  # most units are windows
    parts = int(max(4, entries // similarity.ENTRIES_PER_PART + 1))
    tiles = durable(similarity.shared_tiles(_postings(docs, parts), parts, tags=True), "tiles")
    several = durable(similarity.repeated(places, parts).union(tiles.select("cls")).distinct(), "several")  # all others stand alone
    once = durable(similarity.among(places, several).groupBy("cls").agg(
        F.count("*").alias("size"), F.min("row").alias("low"), F.max("row").alias("high"),
        F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), "row")).alias("first")), "units")
    chosen = durable(tiles.select("cls").distinct().join(once.select("cls", F.col("first.row").alias("row")), "cls"), "chosen")
    contents = durable(_contents(docs, chosen), "contents")
    linked = similarity.link(tiles, contents.select("cls", "n", "bits", "row"), lambda wanted: similarity.picked(contents, wanted))
    named = once.join(linked, F.col("cls") == F.col("node"), "left") \
        .select("cls", "size", "low", "high", "first", F.coalesce("root", "cls").alias("group_id"), F.col("node").isNotNull().alias("links")) \
        .where("size > 1 or links")
    named = durable(named, "named")
    groups = named.groupBy("group_id").agg(
        F.sum("size").alias("group_size"), F.min("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"))
    chosen = durable(named.select("cls", "group_id", "links").join(groups.where("low < high"), "group_id").select(
        "cls", "group_id", "links", "group_size", F.when(F.col("first.doc_id") != (1 << 63) - 1, F.col("first.doc_id")).alias("keep_id"),
        F.col("first.row").alias("keep_row")), "repeated")
    marked = durable(_spots(docs, chosen).join(chosen.drop("links"), "cls").drop("cls")
                     .withColumn("removed", F.col("row") != F.col("keep_row")).drop("keep_row"), "marked")
    kept = marked.where("not removed").groupBy("group_id").agg(F.collect_set(F.struct("lead", "length", "words")).alias("kept"))
    whole = marked.where(~F.col("removed") | (F.col("kind") == PARAGRAPH)).withColumn("end", F.col("start") + F.col("length") + F.col("left_out"))
    fitted = _fitted(marked.where(F.col("removed") & (F.col("kind") != PARAGRAPH)), kept)
    columns = ["doc_id", "row", "start", "end", "group_id", "group_size", "keep_id", "removed"]
    return whole.select(columns).union(fitted.select(columns))


def removals(docs: DataFrame) -> DataFrame:
    """Per document with passages to remove: ``doc_id``, ``spans`` (merged, in words), ``removed_words``, ``keep_ids``.

    ``keep_ids`` are the documents in which those passages stay.
    """
    found = repeats(docs).where("removed")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, sizes = [], []
            for units_ in batch.column("units").to_pylist():
                merged: list[list[int]] = []
                for unit in sorted(units_, key=lambda x: x["start"]):
                    if merged and unit["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], unit["end"])
                    else:
                        merged.append([unit["start"], unit["end"]])
                spans.append(merged)
                sizes.append(sum(b - a for a, b in merged))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(sizes, pa.int64()),
                batch.column("keep_ids")], ["doc_id", "spans", "removed_words", "keep_ids"])

    return found.groupBy("row", "doc_id").agg(
        F.collect_list(F.struct("start", "end")).alias("units"), F.array_sort(F.collect_set("keep_id")).alias("keep_ids")) \
        .select("doc_id", "units", "keep_ids") \
        .mapInArrow(merge, "doc_id long, spans array<array<bigint>>, removed_words long, keep_ids array<bigint>")
