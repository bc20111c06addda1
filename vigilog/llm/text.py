"""Words and shingles of whole texts, as numpy arrays inside Arrow tasks.

Words are runs of bytes other than ASCII white space, lower-cased in A-Z only:
``bytes.lower().split()`` is exactly that rule. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BATCH_ROWS = 1_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(0xD1342543DE82EF95, j, 1 << 64)) for j in range(SHINGLE)]
_CACHE = 400_000
HASH_BYTES = 1 << 16  # bytes whose running sums are taken together; a longer word is taken alone
_BYTE_BASE = 0x9FB21C651E98DF25
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty.

    ``lower`` does just that where every character is one byte; ``translate``
    is exact for the rest but slower.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python tasks a thousand at a time, unless the session asks for fewer: they can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(BATCH_ROWS))


def input_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns never matter."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


class WordHash(dict):
    """Word to 64-bit hash; forgets everything when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def line_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of many texts: the text each is of, its number of words, and 64-bit hashes of all words, one after the other.

    A word's hash is a polynomial of its bytes, taken from running sums over
    HASH_BYTES bytes at a time, so there is no object for a word.
    """
    data = _LOWER[np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)]
    turns = np.flatnonzero(np.diff(np.r_[True, _IS_SPACE[data]]))
    start, stop = turns[::2], turns[1::2]
    newline = np.flatnonzero(data == 10)
    text_end = np.cumsum(np.array([len(t or b"") + 1 for t in texts], np.int64)) - 1
    sizes = np.bincount(np.searchsorted(newline, start), minlength=len(newline))
    hashes = np.empty(len(start), np.uint64)
    edges = np.unique(np.r_[0, np.searchsorted(stop, np.arange(HASH_BYTES, len(data), HASH_BYTES)), len(stop)])
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        first = start[i]
        length = int(stop[j - 1] - first)
        powers, back = _BYTE_POWERS if length <= HASH_BYTES else _byte_powers(length)
        total = np.zeros(length + 1, np.uint64)
        np.cumsum((data[first:first + length].astype(np.uint64) + np.uint64(1)) * powers[:length], out=total[1:])
        begin = start[i:j] - first
        hashes[i:j] = mix((total[stop[i:j] - first] - total[begin]) * back[begin])
    return np.searchsorted(text_end, newline), sizes, hashes


def _byte_powers(n: int) -> list[np.ndarray]:
    return [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (_BYTE_BASE, pow(_BYTE_BASE, -1, 1 << 64))]


def raw(column: pa.Array) -> list:
    """Strings of an Arrow column as bytes, None for null."""
    return column.cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def positions(hashes: np.ndarray) -> np.ndarray:
    """Hash of the five words from each position on; fewer words than five give one for all of them. Rows of a table each for itself."""
    n = hashes.shape[-1]
    if n == 0:
        return np.empty(hashes.shape, np.uint64)
    width = min(n, SHINGLE)
    total = np.full((*hashes.shape[:-1], n - width + 1), np.uint64(width)) * _STEP
    for j in range(width):
        total += hashes[..., j:n - width + 1 + j] * _POWERS[j]
    return mix(total)


def shingle_sets(texts: list, cache: WordHash) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for text in texts:
        words = text.lower().split() if text else []
        yield np.unique(positions(cache.of(words)))


def set_hash(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set; the empty set has 0."""
    if not len(shingles):
        return 0
    total = mix(mix(shingles + _STEP).sum(keepdims=True) + np.uint64(len(shingles)))
    return int(total.view(np.int64)[0])


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bits hit by the shingles, four bits a shingle or more, as signed 64-bit words: a power of two of them."""
    longs = 4
    while longs * 16 < len(shingles):
        longs *= 2
    at = (shingles % np.uint64(longs * 64)).astype(np.int64)
    bits = np.zeros(longs * 64, np.uint8)
    bits[at] = 1
    return np.packbits(bits).view(np.int64)


_BYTE_POWERS = _byte_powers(HASH_BYTES)
