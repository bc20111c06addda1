"""Benchmark questions in documents, found by templates: numbers, names and units are placeholders."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.text import input_columns, positions, raw, small_batches

WINDOW = 5
SHARE = 0.75
ITEMS_PER_BLOCK = 20_000   # benchmark items handed to the tasks at a time
# Units that follow a number.
UNITS = frozenset("""mm cm m km in ft yd mi mile miles metre metres meter meters inch inches foot feet yard yards mg g kg t lb lbs oz ton tons
gram grams pound pounds ounce ounces ml cl l litre litres liter liters gallon gallons s sec secs second seconds min mins minute minutes h hr hrs
hour hours day days week weeks month months year years mph kmh usd eur gbp dollar dollars euro euros cent cents percent degrees kb mb gb tb
hz khz mhz ghz w kw kwh v a j kj cal kcal""".split())
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,]*(?:st|nd|rd|th)?[%€$£]?")
_NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
# Words that begin sentences and are no names.
_OPENERS = frozenset("""a an the this that these those it its he she they we you i his her their our your my what which who whom whose when where
why how if is are was were do does did has have had can could should would shall and or but so then there here in on at to of for from by with
as after before while during each every all some both either neither no not one let find calculate determine given suppose""".split())
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "-+$%")
_EDGE_BYTES = _EDGE.encode()
_CLOSERS, _ENDS, _SIGNS, _NUMBER_STARTS = "\"')]}»”*#&$%", (".", "!", "?", ":", "|"), "-+$%", "-+$€£"
_CLOSERS_BYTES, _ENDS_BYTES = b"\"')]}*#&$%", (b".", b"!", b"?", b":", b"|")
_WORD_FLAGS = {x: (w in _NUMBER_WORDS) | 4 * (w in UNITS) | 32 * (w in _OPENERS)
               for w in _NUMBER_WORDS | UNITS | _OPENERS for x in (w, w.encode())}
PLAIN, NUMBER, NAME, UNIT = range(4)
PLACEHOLDERS = np.array([0, *(xxhash.xxh64_intdigest(f"<{x}>") for x in ("number", "name", "unit"))], np.uint64)


class Tokens(dict):
    """Word to its number; ``hashes`` and ``flags`` have, by that number, the hash in lower case without punctuation and the kind:
    1 number, 2 capital, 4 unit, 8 ends a sentence, 16 nothing left, 32 begins sentences and is no name."""

    def __init__(self):
        self.hashes, self.flags = array("Q"), bytearray()

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(_EDGE_BYTES)
        if plain.isalpha():  # ASCII letters alone between punctuation: no number but a number word
            low = plain.lower()
            flags = _WORD_FLAGS[low] if low in _WORD_FLAGS else 0
            if plain[0] < 97 and plain[1:].islower():
                flags |= 2
            if len(plain) < len(word) and word.rstrip(_CLOSERS_BYTES).endswith(_ENDS_BYTES):
                flags |= 8
        else:
            text = word.decode("utf-8", "replace")
            plain = text.strip(_EDGE)
            low = plain.lower()
            flags = _WORD_FLAGS[low] if low in _WORD_FLAGS else 0
            first = plain[:1]
            if (first.isdigit() or first in _NUMBER_STARTS) and _NUMBER.fullmatch(plain):
                flags |= 1
            if first.isupper() and plain[1:].islower():
                flags |= 2
            if not text[-1:].isalpha() and text.rstrip(_CLOSERS).endswith(_ENDS):
                flags |= 8
            if low[:1] in _SIGNS and not low.strip(_SIGNS):
                flags |= 16
        self.hashes.append(xxhash.xxh64_intdigest(low))
        self.flags.append(flags)
        value = self[word] = len(self.flags) - 1
        return value

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and flags of the words. Forgets everything between texts when it has grown large."""
        if len(self) >= 300_000:
            self.clear()
            self.__init__()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.hashes, np.uint64)[at], np.frombuffer(self.flags, np.uint8)[at]


def template(text: bytes | None, cache: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its own hash, its kind, its hashes in the readings of the template, a row each.

    A number stays for any number, a unit right after a number for any unit, and
    a capitalised word for any name: in the first reading inside a sentence only, in the
    second at its start too. In the third no word is a name (a text may have lost its case), in
    the last all words are as they are. The kind is that of the second reading.
    """
    words = text.split() if text else []
    own, flags = cache.of(words)
    keep = flags & 16 == 0
    inside = np.empty(len(flags), bool)
    inside[:1], inside[1:] = False, flags[:-1] & 8 == 0
    if not keep.all():
        own, flags, inside = own[keep], flags[keep], inside[keep]
    values = np.where(flags & 1, np.int8(NUMBER), np.int8(PLAIN))
    values[1:][(values[1:] == PLAIN) & (flags[1:] & 4 > 0) & (values[:-1] == NUMBER)] = UNIT
    capital = (values == PLAIN) & (flags & 2 > 0)
    kinds = np.tile(values, (4, 1))
    kinds[0][capital & inside] = NAME
    kinds[1][capital & (inside | (flags & 32 == 0))] = NAME
    kinds[3] = PLAIN
    readings = PLACEHOLDERS[kinds]
    np.copyto(readings, own, where=kinds == PLAIN)
    return own, kinds[1], readings


def windows(readings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all readings and their places; equal ones of one place once."""
    all_ = positions(readings)
    fresh = np.ones(all_.shape, bool)
    for i in range(1, len(all_)):
        np.logical_and.reduce(all_[:i] != all_[i], out=fresh[i])
    return all_[fresh], np.nonzero(fresh)[1]


def spaced(text: bytes | None) -> bytes | None:
    """Line ends begin a sentence."""
    return text.replace(b"\n", b" . ") if text and b"\n" in text else text


class Item:
    """A benchmark item: its words, their kinds, its windows in all readings with their places, and how many places there are."""

    def __init__(self, item_id: int, text: bytes | None, cache: Tokens):
        self.item_id = item_id
        self.own, self.kind, readings = template(spaced(text), cache)
        self.windows, self.at = windows(readings)
        self.count = len(positions(self.own))


def consistent(item: Item, own: np.ndarray, offset: int, matched: np.ndarray, slots: tuple[dict, dict] | None = None) -> bool:
    """Whether every slot value of the item stands for one value in the document, over the matched windows of one
    alignment, and distinct values for distinct ones of a kind. With ``slots``, values found before must agree, and new ones are added."""
    words = np.unique((matched[:, None] + np.arange(WINDOW)).ravel())
    words = words[(words < len(item.own)) & (item.kind[np.minimum(words, len(item.own) - 1)] != PLAIN)]
    there = words + offset
    words, there = words[(there >= 0) & (there < len(own))], there[(there >= 0) & (there < len(own))]
    forth, back = slots or ({}, {})
    new, new_back = {}, {}
    for w, d in zip(words, there):
        a, b = (int(item.kind[w]), int(item.own[w])), (int(item.kind[w]), int(own[d]))
        if forth.get(a, b) != b or back.get(b, a) != a or new.setdefault(a, b) != b or new_back.setdefault(b, a) != a:
            return False
    forth.update(new)
    back.update(new_back)
    return True


class Block:
    """Windows of a block of items: sorted hashes, and where each occurs."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        cache = Tokens()
        items = [Item(i, t.encode() if t is not None else None, cache) for i, t in rows]
        self.items = [x for x in items if len(x.own)]
        hashes = np.concatenate([x.windows for x in self.items] or [np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(self.items)), [len(x.windows) for x in self.items])
        at = np.concatenate([x.at for x in self.items] or [np.empty(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.at = hashes[order], item[order], at[order]
        self.hint = np.zeros(1 << 20, bool)
        self.hint[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def matches(self, text: bytes | None, cache: Tokens) -> list[tuple[int, float, bool]]:
        """Item, share of its windows found, and whether values were changed, of each item in the text."""
        own, _, readings = template(spaced(text), cache)
        if not len(own) or not len(self.hashes):
            return []
        hashes, places = windows(readings)
        maybe = np.flatnonzero(self.hint[(hashes >> np.uint64(44)).astype(np.int64)])
        left, right = np.searchsorted(self.hashes, hashes[maybe]), np.searchsorted(self.hashes, hashes[maybe], "right")
        maybe, left, right = maybe[left < right], left[left < right], right[left < right]
        if not len(maybe):
            return []
        place = np.repeat(places[maybe], right - left)
        entry = np.concatenate([np.arange(i, j) for i, j in zip(left, right)])
        item, at = self.item[entry], self.at[entry]
        found = []
        for number in np.unique(item):
            mine = item == number
            whole = self.items[number]
            if len(np.unique(at[mine])) < SHARE * whole.count:
                continue
            offsets = place[mine] - at[mine]
            best = None
            for offset in np.unique(offsets):  # one alignment of the item with the text each
                matched = np.unique(at[mine][offsets == offset])
                share = len(matched) / whole.count
                if share >= SHARE and (best is None or share > best[0]) and consistent(whole, own, int(offset), matched):
                    words = np.unique((matched[:, None] + np.arange(WINDOW)).ravel())
                    words = words[(words < len(whole.own)) & (words + offset < len(own))]
                    best = (share, bool((whole.own[words] != own[words + offset]).any()))
            if best is None and self._apart(whole, own, place[mine], at[mine]):
                best = (len(np.unique(at[mine])) / whole.count, False)
            if best:
                found.append((whole.item_id, float(best[0]), best[1]))
        return found

    @staticmethod
    def _apart(item: Item, own: np.ndarray, place: np.ndarray, at: np.ndarray) -> bool:
        """Windows that only together reach the share, as after an insertion: within twice the item's length, with one value of
        each slot in all of them. Those of like alignment come first, so that a chance window does not set the values."""
        span = 2 * len(item.own)
        order = np.argsort(place, kind="stable")
        place, at = place[order], at[order]
        for i in range(len(place)):
            j = np.searchsorted(place, place[i] + span, "right")
            if len(np.unique(at[i:j])) < SHARE * item.count:
                continue
            offsets, slots, near = place[i:j] - at[i:j], ({}, {}), set()
            for k in np.argsort(abs(offsets - offsets[0]), kind="stable"):
                if consistent(item, own, int(offsets[k]), at[i + k:i + k + 1], slots):
                    near.add(int(at[i + k]))
            if len(near) >= SHARE * item.count:
                return True
        return False


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item in it: ``doc_id``, ``item_id``, ``share``, ``changed``.

    Words lose their case and punctuation, numbers, names and units become
    placeholders (with and without names at sentence starts, and without any names), and windows of five words of these templates are joined by
    hash. An item is in a text when at least 0.75 of its windows are, in one
    alignment in which each of its values stands for one value (or, after
    insertions, close to each other); ``changed`` tells that values
    differ. Items shorter than five words have one window; null and empty
    items and texts match nothing. Repeated documents and items give
    a row each. Other columns are not read.

    The benchmark is the query set: tasks get it in blocks of 20,000 items, so
    what is broadcast is bounded and a large benchmark takes several passes.
    """
    slim = input_columns(docs)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    found = None
    for block in blocks(items):
        part = slim.mapInArrow(_finder(slim.sparkSession.sparkContext.broadcast(Block(block))),
                               "doc_id long, item_id long, share double, changed boolean")
        found = part if found is None else found.union(part)
    return found


def blocks(items: DataFrame, size: int = ITEMS_PER_BLOCK) -> Iterator[list]:
    """The items in blocks of bounded size; an empty benchmark is one empty block."""
    block: list = []
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == size:
            yield block
            block = []
    yield block


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Tokens()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
                rows += [(doc_id, *match) for match in shared.value.matches(text, cache)]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["doc_id", "item_id", "share", "changed"]).astype(
                {"doc_id": "Int64", "item_id": "Int64", "share": "float64", "changed": "bool"}), preserve_index=False)

    return find


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with a benchmark item in them: ``doc_id``, ``item_ids``, ``share``."""
    return leaks(docs, benchmark).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark item in them, with their own columns; rows without text or id stay."""
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for block in blocks(items):
        docs = docs.mapInArrow(_keeper(docs.sparkSession.sparkContext.broadcast(Block(block))), fields)
    return docs


def _keeper(shared):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Tokens()
        for batch in batches:
            clean = [not shared.value.matches(text, cache) for text in raw(batch.column("text"))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return keep
