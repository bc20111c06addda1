"""How the word use of a source differs from its language and from the other sources of it.

Terms are runs of ASCII letters and characters beyond ASCII, lower-cased in A-Z
only. A language keeps the terms in ``LEAST_DOCS`` of its documents or more. In
a group (a source of a language, or a whole language) a kept term has the share
``p = 1 + floor(SHARE * (count + 5) / (N + 5 * V))``; ``N`` sums the counts of
kept terms in the group, ``V`` is their number in the language.

Late strings:

1. A task hashes the words of its documents to 64-bit digests by running sums
   over bytes, compares each word with the one its digest stands for, and adds
   up (language, source, digest) before anything leaves it. Its rows are written
   once; a string stands in the first row of a digest only, as the smallest and
   largest string that the task has met under it.
2. Only digests with counts are shuffled, once, by (language, digest).
3. Strings are read again for digests that are kept (a table of bits, of at
   most 8 MB, stops the others before they move). Where the smallest and the
   largest string differ, the digest is split: its words are counted again by
   their strings, and each becomes a term of its own. No string under a digest
   can be kept when the digest is not, as the digest is in as many documents.
4. Distances of sources are sums over blocks of terms: a task has the counts of
   one block in one language, as a matrix of sources by terms, and gives one
   number per pair of sources. Terms without an occurrence count as 0, not as
   missing.
5. The best terms of a group are cut by rank before the shuffle, all ties of the
   last rank included; their strings decide among ties and are joined to these
   rows alone.

Null text, language and source are empty. Every (language, source) that occurs
is a group, also without any term; a language without kept terms has distances
of 0 and no term rows. A source that is alone in its language has no pairs.
Repeated rows are documents of their own. A text of any length is read whole, in
slices at word ends. An empty table gives no rows; other columns than text, lang
and source are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm import text
from vigilog.session import durable

LEAST_DOCS = 30
PRIOR = 5
SHARE = 1_000_000_000
TOP = 50
SLICE = 1 << 20
FLUSH = 1 << 19
BLOCK_ROWS, LEAST_BLOCKS = 50_000, 64
MOST_SPLIT = 1_000_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = text.mix(_LOWER.astype(np.uint64) + np.uint64(1))
_STEP = 0x9E3779B97F4A7C15
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
COUNTS = "lang string, source string, digest long, n long, docs long, lo string, hi string"


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    BASE = 0xD1342543DE82EF95

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, SLICE + 1)
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in the bytes of several texts; a text's edge ends a term."""
    inside = _LETTER[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def digests_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: _Powers, bits: int) -> np.ndarray:
    powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers.up[:len(data)], out=sums[1:])
    own = (sums[stops] - sums[starts]) * powers.down[starts]
    return text.mix(own + (stops - starts).astype(np.uint64) * np.uint64(_STEP)) >> np.uint64(64 - bits)


def differing(low: np.ndarray, starts: np.ndarray, stops: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Words that aren't the same bytes as the word ``like`` names; ``low`` has eight bytes to spare at its end."""
    eights = np.ndarray(len(low) - 7, np.uint64, low, strides=(1,))
    lengths = stops - starts
    odd = lengths != lengths[like]
    at = np.flatnonzero(~odd & (like != np.arange(len(like))))
    for j in range(8):
        at = at[lengths[at] > 8 * j]
        if not len(at):
            break
        mask = _MASKS[np.minimum(lengths[at] - 8 * j, 8)]
        odd[at[(eights[starts[at] + 8 * j] ^ eights[starts[like[at]] + 8 * j]) & mask != 0]] = True
    for i in at[lengths[at] > 64]:
        k = like[i]
        if not np.array_equal(low[starts[i]:stops[i]], low[starts[k]:stops[k]]):
            odd[i] = True
    return np.flatnonzero(odd)


class _Counter:
    """Counts of a task, by group and digest, and the strings its digests stand for."""

    def __init__(self, bits: int):
        self.bits, self.powers = bits, _Powers()
        self.reset()

    def reset(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.strings: dict[int, tuple[bytes, bytes]] = {}

    def code(self, group: tuple[str, str]) -> int:
        return self.groups.setdefault(group, len(self.groups))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...] | None:
        """Text number, digest and count of the distinct terms of each text of a slice."""
        starts, stops = find_words(data, offsets)
        if not len(starts):
            return None
        found = digests_of(data, starts, stops, self.powers, self.bits)
        kinds, first, kind = np.unique(found, return_index=True, return_inverse=True)
        low = np.append(_LOWER[data], np.zeros(8, np.uint8))
        for i in [*first.tolist(), *differing(low, starts, stops, first[kind]).tolist()]:
            word, digest = low[starts[i]:stops[i]].tobytes(), int(found[i])
            known = self.strings.get(digest)
            if known is None:
                self.strings[digest] = (word, word)
            elif not known[0] <= word <= known[1]:
                self.strings[digest] = (min(known[0], word), max(known[1], word))
        number = np.searchsorted(offsets, starts, "right") - 1
        keys, n = np.unique(number * len(kinds) + kind, return_counts=True)
        return keys // len(kinds), kinds[keys % len(kinds)], n

    def add(self, codes: np.ndarray, digests: np.ndarray, n: np.ndarray) -> None:
        """Distinct terms of some texts; ``codes`` has the group of each row."""
        self.rows.append((codes, digests, n, np.ones(len(n), np.int64)))
        self.size += len(n)

    def merge(self) -> None:
        if self.rows:
            codes, digests, n, docs = (np.concatenate(c) for c in zip(*self.rows, strict=True))
            order = np.lexsort((codes, digests))
            codes, digests = codes[order], digests[order]
            new = np.flatnonzero(np.append(True, (np.diff(codes) != 0) | (digests[1:] != digests[:-1])))
            self.rows = [(codes[new], digests[new], np.add.reduceat(n[order], new), np.add.reduceat(docs[order], new))]
            self.size = len(new)

    @property
    def full(self) -> bool:
        if self.size > 2 * FLUSH:
            self.merge()
            if self.size > FLUSH:
                return True
        return len(self.strings) > FLUSH or len(self.groups) > FLUSH

    def flush(self) -> Iterator[pa.RecordBatch]:
        """All groups, then the rows by digest; strings in the first row of each digest."""
        self.merge()
        langs, sources = (pa.array(c, pa.string()) for c in (zip(*self.groups, strict=True) if self.groups else ((), ())))
        none = pa.nulls(len(langs), pa.int64())
        zero = pa.array(np.zeros(len(langs), np.int64))
        text_none = pa.nulls(len(langs), pa.string())
        names = [c.split()[0] for c in COUNTS.split(", ")]
        yield pa.RecordBatch.from_arrays([langs, sources, none, zero, zero, text_none, text_none], names)
        for codes, digests, n, docs in self.rows:
            lead = np.append(True, digests[1:] != digests[:-1])
            for at in range(0, len(n), 50_000):
                cut = slice(at, at + 50_000)
                pairs = [self.strings[d] if f else (None, None) for d, f in zip(digests[cut].tolist(), lead[cut].tolist(), strict=True)]
                code = pa.array(codes[cut])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(code), sources.take(code), pa.array(digests[cut].view(np.int64)), pa.array(n[cut]), pa.array(docs[cut]),
                     *(pa.array(side, pa.binary()).cast(pa.string()) for side in zip(*pairs, strict=True))], names)
        self.reset()


def _texts(batch: pa.RecordBatch) -> tuple[list, np.ndarray, np.ndarray]:
    """Groups, bytes and offsets of a batch of (lang, source, text), nulls as empty."""
    if not batch.num_rows:
        return [], np.empty(0, np.uint8), np.zeros(1, np.int64)
    groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    column = batch.column(2).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return groups, data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to ``SLICE`` bytes together; a longer text alone."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, end
        at = end


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``SLICE`` bytes that end where no term is cut."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and _LETTER[data[end]]:
            gap = np.flatnonzero(~_LETTER[data[end:end + SLICE]])
            end = end + int(gap[0]) if len(gap) else min(end + SLICE, len(data))
        yield data[at:end]
        at = end


def _inputs(docs: DataFrame) -> DataFrame:
    text.small_batches(docs.sparkSession)
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def count_terms(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Written rows of tasks: lang, source, digest, n, docs, lo, hi; a row without digest for every group."""

    def run(batches):
        counter = _Counter(bits)
        one = np.zeros(1, np.int64)
        for batch in batches:
            groups, data, offsets = _texts(batch)
            for at, end in _slices(data, offsets):
                codes = np.array([counter.code(g) for g in groups[at:end]], np.int64)
                body = data[offsets[at]:offsets[end]]
                if end == at + 1 and len(body) > SLICE:
                    found = [w for w in (counter.words(piece, one) for piece in _pieces(body)) if w is not None]
                    if found:
                        digests, where = np.unique(np.concatenate([w[1] for w in found]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([w[2] for w in found])).astype(np.int64)
                        counter.add(np.full(len(n), codes[0]), digests, n)
                elif (found := counter.words(body, offsets[at:end] - offsets[at])) is not None:
                    counter.add(codes[found[0]], found[1], found[2])
                if counter.full:
                    yield from counter.flush()
        if counter.groups:
            yield from counter.flush()

    return durable(_inputs(docs).mapInArrow(run, COUNTS), "term-counts")


def _members(digests: DataFrame) -> tuple[int, bytes]:
    """Bits that the digests hit: a power of two of them, 16 for each digest, 2^26 at most."""
    width = min(26, max(16, (16 * digests.count()).bit_length()))
    slots = digests.select((F.col("digest").bitwiseAND((1 << width) - 1)).alias("s"))
    rows = slots.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).collect()
    table = np.zeros(1 << (width - 6), np.int64)
    for r in rows:
        table[r.w] = r.b
    return width, table.tobytes()


def strings_of(counted: DataFrame, kept: DataFrame) -> DataFrame:
    """Smallest and largest string of every kept digest: digest, lo, hi."""
    width, bits = _members(kept)

    def few(batches):
        table = np.frombuffer(bits, np.int64)
        for batch in batches:
            slot = batch.column(0).to_numpy() & ((1 << width) - 1)
            yield batch.filter(pa.array((table[slot >> 6] >> (slot & 63)) & 1 == 1))

    rows = counted.where("lo is not null").select("digest", "lo", "hi").mapInArrow(few, "digest long, lo string, hi string")
    return rows.groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).join(kept, "digest", "left_semi")


def _split_counts(docs: DataFrame, split: DataFrame, bits: int) -> DataFrame:
    """Terms under colliding digests, counted by their strings: lang, source, digest, term, n, docs."""
    few = frozenset(r.digest for r in split.limit(MOST_SPLIT + 1).collect())
    wanted = few if len(few) <= MOST_SPLIT else None

    def run(batches):
        powers = _Powers()
        for batch in batches:
            groups, data, offsets = _texts(batch)
            out = []
            for i, group in enumerate(groups):
                own: dict[tuple[int, bytes], int] = {}
                for piece in _pieces(data[offsets[i]:offsets[i + 1]]):
                    starts, stops = find_words(piece, np.zeros(1, np.int64))
                    found = digests_of(piece, starts, stops, powers, bits).view(np.int64).tolist()
                    low = _LOWER[piece].tobytes()
                    for d, a, b in zip(found, starts.tolist(), stops.tolist(), strict=True):
                        if wanted is None or d in wanted:
                            own[d, low[a:b]] = own.get((d, low[a:b]), 0) + 1
                out += [(*group, d, w, n) for (d, w), n in own.items()]
            if out:
                langs, sources, digests, words, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(digests, pa.int64()),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["lang", "source", "digest", "term", "n"])

    rows = _inputs(docs).mapInArrow(run, "lang string, source string, digest long, term string, n long")
    rows = rows.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
    return rows.join(split.select("digest"), "digest", "left_semi").select("lang", "source", "digest", "term", "n", "docs")


def _kept(counts: DataFrame, least_docs: int, key: list[str]) -> DataFrame:
    """Rows of terms in enough documents of their language, with the count there."""
    whole = Window.partitionBy("lang", *key)
    rows = counts.withColumn("_docs", F.sum("docs").over(whole)).withColumn("lang_n", F.sum("n").over(whole))
    return rows.where(F.col("_docs") >= least_docs).select("lang", "source", *key, "n", "lang_n")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS, bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of kept terms (lang, source, digest, term, n, lang_n), their strings (digest, string), and all groups.

    ``term`` is null unless the digest stands for several strings.
    """
    counted = count_terms(docs, bits)
    rows = counted.where("digest is not null").select("lang", "source", "digest", "n", "docs")
    rows = rows.repartition("lang", "digest").groupBy("lang", "digest", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = durable(_kept(rows, least_docs, ["digest"]), "kept-terms")
    strings = durable(strings_of(counted, kept.select("digest").distinct()), "term-strings")
    split = strings.where("lo <> hi").select("digest")
    whole = kept.select("lang", "source", "digest", F.lit(None).cast("string").alias("term"), "n", "lang_n")
    if not split.isEmpty():
        again = durable(_kept(_split_counts(docs, split, bits), least_docs, ["digest", "term"]), "split-terms")
        whole = durable(whole.join(split, "digest", "left_anti").select(*again.columns).unionByName(again), "kept-terms")
    groups = counted.where("digest is null").select("lang", "source").distinct()
    return whole, strings.select("digest", F.col("lo").alias("string")), groups


def share(n: Column, total: Column) -> Column:
    """``1 + floor(SHARE * n / total)`` for ``0 <= n <= total``, three digits at a time, so nothing leaves 64 bits."""
    value, rest, step = F.lit(0).cast("long"), n, F.lit(1000).cast("long")
    for _ in range(3):
        rest = rest * step
        value, rest = value * step + F.call_function("div", rest, total), rest % total
    return F.lit(1).cast("long") + F.when(n == total, F.lit(SHARE).cast("long")).otherwise(value)


def with_totals(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every group with N (own and of the language) and V."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.select("lang", "digest", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    rows = groups.join(own, ["lang", "source"], "left").join(terms, "lang", "left")
    return rows.select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "lang_total")))


def pair_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of differences of shares over all kept terms, for every two sources of a language: lang, source, item, value."""
    blocks = max(LEAST_BLOCKS, -(-kept.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("digest", "term"), F.lit(blocks)).cast("int")
    terms = kept.select("lang", block.alias("block"), "source", "digest", "term", "n")
    # Every block needs all sources of its language, also those without a term in it.
    everywhere = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "source", "total", "v")

    def distances(_, counts: pa.Table, sources: pa.Table) -> pa.Table:
        names = sources.column("source").to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        names = [names[i] for i in order]
        totals = np.array(sources.column("total").to_pylist(), object)[order]
        v = sources.column("v")[0].as_py() if len(names) else 0
        g = len(names)
        value = np.zeros((g, g), np.int64)
        if counts.num_rows:
            place = {s: i for i, s in enumerate(names)}
            at = np.array([place[s] for s in counts.column("source").to_pylist()])
            keys = {k: None for k in zip(counts.column("digest").to_pylist(), counts.column("term").to_pylist(), strict=True)}
            keys = {k: i for i, k in enumerate(keys)}
            of = np.array([keys[k] for k in zip(counts.column("digest").to_pylist(), counts.column("term").to_pylist(), strict=True)])
            n = np.array(counts.column("n").to_pylist(), object)
            shares = np.array([1 + SHARE * (int(c) + PRIOR) // (int(totals[s]) + PRIOR * v) for c, s in zip(n, at, strict=True)], np.int64)
            empty = np.array([1 + SHARE * PRIOR // (int(t) + PRIOR * v) for t in totals], np.int64)
            wide = max(1, (1 << 20) // g)
            for first in range(0, len(keys), wide):
                here = (of >= first) & (of < first + wide)
                matrix = np.repeat(empty[:, None], min(wide, len(keys) - first), 1)
                matrix[at[here], of[here] - first] = shares[here]
                for i in range(g):
                    value[i] += np.abs(matrix - matrix[i]).sum(1)
        one, two = np.nonzero(~np.eye(g, dtype=bool))
        lang = sources.column("lang")[0].as_py() if g else None
        return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "source": pa.array([names[i] for i in one], pa.string()),
                         "item": pa.array([names[i] for i in two], pa.string()), "value": pa.array(value[one, two], pa.int64())})

    parts = terms.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")).applyInArrow(
        distances, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def distinctive(kept: DataFrame, strings: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """Terms that a group uses more than its language does, by falling difference, to ``top``: lang, source, item, value, rank."""
    prior, weight = F.lit(PRIOR).cast("long"), F.lit(PRIOR).cast("long") * F.col("v")
    rows = kept.join(groups, ["lang", "source"])
    rows = rows.withColumn("value", share(F.col("n") + prior, F.col("total") + weight)
                           - share(F.col("lang_n") + prior, F.col("lang_total") + weight)).where("value > 0")
    group = Window.partitionBy("lang", "source")
    best = rows.withColumn("_rank", F.rank().over(group.orderBy(F.desc("value")))).where(F.col("_rank") <= top)
    named = best.select("lang", "source", "digest", "term", "value").join(strings, "digest")
    named = named.select("lang", "source", F.coalesce("term", "string").alias("item"), "value")
    return named.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """Both parts: lang, source, part (pair or term), item, value, rank."""
    kept, strings, groups = kept_terms(docs, least_docs, bits)
    groups = durable(with_totals(kept, groups), "term-groups")
    pairs = pair_distances(kept, groups).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = distinctive(kept, strings, groups, top)
    shape = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*shape).unionByName(terms.withColumn("part", F.lit("term")).select(*shape))
