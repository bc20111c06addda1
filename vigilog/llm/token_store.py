"""Token ids of documents in Huffman-coded files."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigilog.llm.text import raw, small_batches
from vigilog.session import durable, scratch_dir

END = 2
MOST_BITS = 17             # longest code; three bytes hold one at any bit
LANE = 64                  # tokens between two checkpoints
BLOCK_TOKENS = 65_536      # a block ends with the document that reaches this
PART_TOKENS = 8_000_000    # tokens of a file, about
PIECE_BYTES = 8 << 20      # of text that is split at a time
_CACHE = 600_000
_PUNCTUATION = b".,#*&$%!|:;?"
_STEM_END = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# The letters of bytes that no printable character has: U+0100 on, in order (fixed by the vocabulary files).
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


# --- tokenizing

class WordIds(dict):
    """Ids of a word between white space, as bytes. Keeps the last one or two times _CACHE words.

    The tokenizer cuts at white space and treats each piece by itself, so a
    text's ids are those of its words in a row. A run of punctuation after a
    letter or digit is a piece of its own, and ASCII case does not matter unless
    the word may hold a special token. A word of small Latin-1 letters is one
    piece that no rule before the model changes, so the model gets its bytes
    directly, written as the letters that stand for bytes.
    """

    def __init__(self, file: str, kind: str):
        super().__init__()
        self.tokenizer, self.older = Tokenizer.from_file(file), {}
        self.model, self.pack = self.tokenizer.model, {"<u2": "H", "<u4": "I"}[kind]

    def _encode(self, word: bytes) -> bytes:
        return array(self.pack, self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _CACHE:
            self.older = dict(self)
            self.clear()
        value = self.older.get(word)
        if value is None:
            value = self._fresh(word)
        self[word] = value
        return value

    def _fresh(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text):
            piece = text if word.isascii() else word.decode("latin-1").translate(_BYTE_LETTERS)
            return array(self.pack, [token.id for token in self.model.tokenize(piece)]).tobytes()
        if b"<" in word:
            return self._encode(word)
        if not word.isascii():
            stem = word.rstrip(_PUNCTUATION)
            if stem == word and text != text.lower() and _PLAIN.fullmatch(text.lower()):
                return self[text.lower().encode()]
            letter = stem.decode("utf-8", "replace")[-1:].lower()[-1:]
            return self._encode(word) if stem == word or not letter.isalpha() else self[stem] + self[word[len(stem):]]
        low = word.lower()
        stem = low.rstrip(_PUNCTUATION)
        if stem == low or not stem[-1:].isalnum():
            return self[low] if low != word else self._encode(low)
        return self[stem] + self[low[len(stem):]]


_WORDS: dict = {}


def word_ids(file: str, kind: str) -> WordIds:
    """One cache per Python worker, kept from task to task."""
    if (file, kind) not in _WORDS:
        _WORDS[file, kind] = WordIds(file, kind)
    return _WORDS[file, kind]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, some megabytes of text at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def _bytes(words: pa.Array) -> list[bytes]:
    """Words without null as bytes, without a scalar for each."""
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _known(distinct: pa.Array, words: WordIds) -> list[bytes]:
    """Ids of distinct words.

    Arrow lower-cases ASCII words and cuts punctuation behind letters and digits, so that only distinct stems are
    looked up. A word with "<" may hold a special token and is looked up as it is.
    """
    free = pc.invert(pc.match_substring(distinct, "<"))
    low = pc.if_else(pc.and_(free, pc.string_is_ascii(distinct)), pc.ascii_lower(distinct), distinct)
    stems = pc.ascii_rtrim(low, characters=_PUNCTUATION.decode())
    cut = pc.and_(pc.and_(free, pc.not_equal(stems, low)), pc.match_substring_regex(stems, _STEM_END))
    named = pc.dictionary_encode(pc.if_else(cut, stems, low))
    found = [words[word] if word else b"" for word in _bytes(named.dictionary)]
    known = [found[i] for i in named.indices.to_numpy().tolist()]
    at = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
    sizes = pc.binary_length(stems.filter(cut)).to_numpy().tolist()
    for i, word, size in zip(at.tolist(), _bytes(low.filter(cut)), sizes):
        known[i] += words[word[size:]]
    return known


def ids_of(texts: pa.Array, words: WordIds, kind: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each with the end id, and their number per text.

    Arrow splits the texts and names their distinct words; only the stems of these are looked up.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    named = pc.dictionary_encode(lists.flatten())
    known = _known(named.dictionary, words)
    known.append(np.array([end], kind).tobytes())
    length = np.array([len(x) for x in known], np.int64) // np.dtype(kind).itemsize
    first = np.cumsum(length) - length
    table = np.frombuffer(b"".join(known), kind)
    offsets = lists.offsets.to_numpy()
    at = np.insert(named.indices.to_numpy().astype(np.int64), offsets[1:] - offsets[0], len(known) - 1)
    n = length[at]
    stops = np.cumsum(n)
    ids = table[np.repeat(first[at] - (stops - n), n) + np.arange(int(n.sum()))]
    marks = np.flatnonzero(at == len(known) - 1)
    return ids, np.diff(np.r_[0, stops[marks]])


def tokenize(docs: DataFrame, file: str, end: int = END) -> DataFrame:
    """Kind 0: ``row``, ``doc_id``, ``ids`` (packed) and ``n``. Kind 1: counts (``n``) of the ids (``row``)."""
    size = max(Tokenizer.from_file(file).get_vocab_size(), end + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = word_ids(file, kind), np.zeros(size, np.int64)
        for batch in batches:
            for piece in _pieces(batch):
                ids, n = ids_of(piece.column("text"), words, kind, end)
                counts += np.bincount(ids, minlength=size)
                ends = np.r_[0, np.cumsum(n * ids.itemsize)].astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(n), np.int32)), piece.column("row"), piece.column("doc_id"), pa.array(n), packed],
                    ["kind", "row", "doc_id", "n", "ids"])
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * len(at), pa.int32()), pa.array(at, pa.int64()), pa.nulls(len(at), pa.int64()),
             pa.array(counts[at]), pa.nulls(len(at), pa.binary())], ["kind", "row", "doc_id", "n", "ids"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(encode, "kind int, row long, doc_id long, n long, ids binary")


# --- the code

def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with none over ``most`` bits, 0 for ids that do not occur (package merge)."""
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) <= 1:
        lengths[symbols] = 1
        return lengths
    if len(symbols) > 1 << most:
        raise ValueError(f"{len(symbols)} ids do not fit into codes of {most} bits")
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    leaves = counts[symbols].astype(np.int64)
    level, levels = leaves, [np.ones(len(leaves), bool)]
    for _ in range(most - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.r_[leaves, pairs]
        order = np.argsort(both, kind="stable")
        level = both[order]
        levels.append(order < len(leaves))
    need = 2 * len(symbols) - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:need].sum())
        lengths[symbols[:own]] += 1
        need = 2 * (need - own)
    return lengths


class Code:
    """The canonical code of given lengths: codes in order of length, then id."""

    def __init__(self, lengths: np.ndarray, most: int = MOST_BITS):
        self.lengths, self.most = lengths, most
        symbols = np.flatnonzero(lengths)
        symbols = symbols[np.argsort(lengths[symbols], kind="stable")]
        spans = np.int64(1) << (most - lengths[symbols].astype(np.int64))
        starts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[symbols] = (starts >> (most - lengths[symbols].astype(np.int64))).astype(np.uint64)
        self.symbol = np.zeros(1 << most, np.uint32)
        self.length = np.ones(1 << most, np.uint8)
        total = int(spans.sum())
        self.symbol[:total], self.length[:total] = np.repeat(symbols, spans), np.repeat(lengths[symbols], spans)

    def encode(self, texts: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
        """Bits of each text from a byte of its own on, and bits between its checkpoints."""
        ids = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
        width = self.lengths[ids].astype(np.int64)
        counts = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(counts)
        run = np.r_[0, np.cumsum(width)]
        bits = run[ends] - run[ends - counts]
        size = (bits + 7) // 8
        base = (np.cumsum(size) - size) * 8
        at = run[:-1] + np.repeat(base - run[ends - counts], counts)
        word, off = at >> 6, at & 63
        value = self.codes[ids]
        room = 64 - off - width
        front = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64))
        words = np.zeros(int(size.sum()) // 8 + 2, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[first]] = np.bitwise_or.reduceat(front, first)
            over = room < 0
            words[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
        data = words.astype(">u8").tobytes()
        payload = [data[b // 8:b // 8 + s] for b, s in zip(base.tolist(), size.tolist())]
        marks = []
        for start, n in zip((ends - counts).tolist(), counts.tolist()):
            points = run[start:start + n:LANE]
            marks.append(np.diff(points).astype("<u2").tobytes())
        return payload, marks

    def decode(self, payload: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of lanes that begin at these bits and have so many tokens, in a row. All lanes advance together by table."""
        data = np.frombuffer(payload + b"\0\0\0", np.uint8).astype(np.uint32)
        window = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        order = np.argsort(-counts, kind="stable")
        at, left = starts[order].astype(np.int64), counts[order]
        out = np.zeros((len(at), int(counts.max(initial=0))), np.uint32)
        for step in range(out.shape[1]):
            live = int(np.searchsorted(-left, -step, "left"))
            now = at[:live]
            code = (window[now >> 3] >> (24 - self.most - (now & 7)).astype(np.uint32)) & np.uint32((1 << self.most) - 1)
            out[:live, step] = self.symbol[code]
            at[:live] = now + self.length[code]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return out[back][np.arange(out.shape[1])[None, :] < counts[:, None]]


# --- files


BLOCKS = "part int, block int, first long, doc_ids array<bigint>, counts array<bigint>, sizes array<bigint>, checkpoints binary, payload binary"


def write(docs: DataFrame, path: str, file: str, end: int = END) -> None:
    """Encode all documents into ``path``: ``code`` (one row, the lengths by id) and ``blocks``.

    Documents are in ascending order of doc_id, null first, repeated ids in the
    order of the table. A block holds whole documents: ids, token counts,
    bytes of each, bits between checkpoints, and the bits; it can be read
    alone. ``first`` is its number of tokens from the start of its part. Null and empty texts
    have the end id alone. An empty table gives a code without ids and no block.

    The code comes from counts over all documents, one row per id of the
    vocabulary. Parts are ranges of doc_id by quantiles; what is shuffled is already coded.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = max(Tokenizer.from_file(file).get_vocab_size(), end + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = durable(tokenize(docs, file, end), "tokens")
    counts = np.zeros(size, np.int64)
    for row in tokens.where("kind = 1").groupBy("row").agg(F.sum("n").alias("n")).collect():  # the vocabulary at most
        counts[row["row"]] = row["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{path}/code")
    coder = spark.sparkContext.broadcast(Code(lengths))
    texts = tokens.where("kind = 0").select("row", "doc_id", "ids")
    parts = int(counts.sum() // PART_TOKENS + 1)
    cuts = texts.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = np.unique(np.array(cuts, np.int64))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            packed = [np.frombuffer(x, kind) for x in raw(batch.column("ids"))]
            payload, marks = coder.value.encode(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(bounds, known, "left"), pa.int32()), batch.column("row"), ids,
                 pa.array([len(x) for x in packed], pa.int64()), pa.array(marks, pa.binary()), pa.array(payload, pa.binary())],
                ["part", "row", "doc_id", "n", "marks", "payload"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, number, first = None, [], 0, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["part"] != part or size >= BLOCK_TOKENS):
                    yield block(part, number, first, held)
                    number, first, held, size = number + 1, first + size, [], 0
                if row["part"] != part:
                    part, number, first = row["part"], 0, 0
                held.append(row)
                size += row["n"]
        if held:
            yield block(part, number, first, held)

    def block(part: int, number: int, first: int, held: list) -> pa.RecordBatch:
        many = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
            pa.array([[r["doc_id"] for r in held]], many), pa.array([[r["n"] for r in held]], many),
            pa.array([[len(r["payload"]) for r in held]], many), pa.array([b"".join(r["marks"] for r in held)], pa.binary()),
            pa.array([b"".join(r["payload"] for r in held)], pa.binary())],
            ["part", "block", "first", "doc_ids", "counts", "sizes", "checkpoints", "payload"])

    coded = texts.mapInArrow(encode, "part int, row long, doc_id long, n long, marks binary, payload binary")
    coded.repartition(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "row") \
        .mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written store: ``doc_id``, ``start`` (ids of all before it), ``n_tokens``, ``ids`` (4 bytes each)."""
    return _decode(spark, path, False)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """As ``read``, with ``ids_crc32`` in place of the ids."""
    return _decode(spark, path, True)


def _decode(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").first()["lengths"], np.uint8)
    coder = spark.sparkContext.broadcast(Code(lengths))
    stored = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = stored.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")) \
        .groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one number per file
    sums = np.cumsum([0, *(r["n"] for r in totals)]).tolist()
    before = dict(zip([r["part"] for r in totals], sums))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder.value
        for batch in batches:
            for row in batch.to_pylist():
                counts, sizes = np.array(row["counts"], np.int64), np.array(row["sizes"], np.int64)
                lanes = -(-counts // LANE)
                steps = np.frombuffer(row["checkpoints"], "<u2").astype(np.int64)
                run = np.zeros(int(lanes.sum()), np.int64)
                head = np.cumsum(lanes) - lanes
                inner = np.ones(len(run), bool)
                inner[head] = False
                run[inner] = steps
                run = np.cumsum(run)
                starts = run - np.repeat(run[head], lanes) + np.repeat((np.cumsum(sizes) - sizes) * 8, lanes)
                size = np.full(len(run), LANE, np.int64)
                size[np.cumsum(lanes) - 1] = counts - (lanes - 1) * LANE
                ids = code.decode(row["payload"], starts, size).astype("<u4")
                ends = np.cumsum(counts)
                pieces = [ids[e - n:e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
                first = before[row["part"]] + row["first"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(first + ends - counts), pa.array(counts),
                    pa.array([zlib.crc32(p) for p in pieces], pa.int64()) if digest else pa.array(pieces, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    last = "ids_crc32 long" if digest else "ids binary"
    return stored.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {last}")


def round_trip(docs: DataFrame, file: str, end: int = END) -> DataFrame:
    """Write the documents below the shared scratch folder and read them back as checksums."""
    path = scratch_dir(docs.sparkSession, "token-store")
    write(docs, path, file, end)
    return checksums(docs.sparkSession, path)
