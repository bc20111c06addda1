"""Toxicity by a factorization machine over hashed terms.

Every term of a text is hashed into a space of fixed size, and all of it is
learned: a weight and ``FACTORS`` factors for each hashed term, whether or not
the term tells the classes apart by itself. What only a pair of terms says is
learned by the product of their factors. A document's value is ``w0`` + the sum
of its terms' weights + the sum of products over all pairs of them, divided by the
number of terms so that long texts don't drown in pairs, through a sigmoid.

Training takes a bounded sample of labelled documents, in order of a hash of
the id: ``TRAINING_ROWS`` at most, and of these the first whose distinct terms
are ``TRAINING_TERMS`` together. One task learns from them, and the machine, a
table of fixed size, is all that reaches the driver. Terms that no training document has say nothing, so their
weights are 0. Without a toxic label every score is below 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.llm.text import raw, small_batches
from vigilog.session import durable

TERMS = 1 << 18               # hashed terms
TRAINING_ROWS = 20_000        # labelled documents that are fitted on, at most
TRAINING_TERMS = 12_000_000   # distinct terms of these documents, added up, at most
FACTORS = 8
UPDATES = 400                 # batches that are learned from; small tables are passed over more often
BATCH = 256
RATE, BIAS_RATE = 20.0, 1.0   # of the slopes of a batch; steps are equal for all terms, so frequent terms are learned before rare ones
PENALTY = 1e-4
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Terms(dict):
    """Word to hashed term, -1 for none: lower case, without ASCII punctuation around it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        plain = word.decode("utf-8", "replace").lower().strip(_EDGE)
        value = self[word] = xxhash.xxh64_intdigest(plain.encode()) % TERMS if plain else -1
        return value


def terms_of(text: bytes | None, cache: dict) -> np.ndarray:
    """Distinct terms of a whole text."""
    words = text.split() if text else []
    terms = np.unique(np.fromiter(map(cache.__getitem__, words), np.int32, len(words)))
    return terms[1:] if len(terms) and terms[0] < 0 else terms


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id is in fold 0: it has no label anyway."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


class Machine:
    """``w0``, and a row of weight and factors for every hashed term."""

    def __init__(self, w0: float, rows: np.ndarray):
        self.w0, self.rows = w0, rows

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Of documents given by their distinct terms."""
        return 1 / (1 + np.exp(-np.clip(self._values(docs)[0], -30, 30).astype(np.float64)))

    def _values(self, docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Values of documents, sums of their rows, and the terms and rows themselves one after the other."""
        counts = np.array([len(d) for d in docs], np.int64)
        terms = np.concatenate([*docs, np.empty(0, np.int32)])
        own = self.rows[terms]
        total, squares = np.zeros((len(docs), own.shape[1]), np.float32), np.zeros(len(docs), np.float32)
        some = counts > 0
        starts = (np.cumsum(counts) - counts)[some]
        if len(starts):
            total[some] = np.add.reduceat(own, starts, axis=0)
            squares[some] = np.add.reduceat((own[:, 1:] ** 2).sum(axis=1), starts)
        pairs = 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares) / np.maximum(counts, 1).astype(np.float32)
        return self.w0 + total[:, 0] + pairs, total, terms, own, counts


def fit_machine(docs: list[np.ndarray], labels: np.ndarray, seed: int = 5, size: int = TERMS, updates: int = UPDATES) -> Machine:
    """Logistic loss by small batches of plain steps; a batch touches the terms it has."""
    draw = np.random.default_rng(seed)
    y = labels.astype(np.float32)
    share = (float(y.sum()) + 0.5) / (len(y) + 2)
    rows = np.zeros((size, FACTORS + 1), np.float32)
    rows[:, 1:] = draw.normal(0, 0.02, (size, FACTORS))
    machine = Machine(float(np.log(share / (1 - share))), rows)
    seen = np.zeros(size, bool)
    for d in docs:
        seen[d] = True
    rows[~seen] = 0
    if not len(y) or y.min() == y.max():  # one class, or no document: nothing to tell apart
        rows[:] = 0
        return machine
    for _ in range(-(-updates // -(-len(docs) // BATCH))):
        order = draw.permutation(len(docs))
        for start in range(0, len(order), BATCH):
            part = order[start:start + BATCH]
            value, total, terms, own, counts = machine._values([docs[i] for i in part])
            error = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - y[part]).astype(np.float32)
            row = np.repeat(np.arange(len(part)), counts)
            others = (total[row, 1:] - own[:, 1:]) / counts.astype(np.float32)[row, None]
            slope = np.c_[np.ones(len(row), np.float32), others] * error[row, None]
            if len(terms):
                by = np.argsort(terms, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(terms[by]) != 0])
                at = terms[by][first]
                gradient = np.add.reduceat(slope[by], first, axis=0) / len(part) + PENALTY * rows[at]
                rows[at] -= RATE * gradient
            machine.w0 -= BIAS_RATE * float(error.mean())
    return machine


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, terms: int = TRAINING_TERMS) -> DataFrame:
    """Labelled documents outside the held-out fold, in order of a hash of the id, while they stay within both bounds:
    ``place`` (the hash), ``doc_id``, ``toxic``, ``n`` and ``terms``.

    A document with several labels is toxic when one says so; null labels and
    labels without a document are passed over, and of repeated documents one row is used.
    """
    spark = docs.sparkSession
    small_batches(spark)
    labelled = labels.where("toxic is not null and doc_id is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")) \
        .where(fold(F.col("doc_id")) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    chosen = spark.sparkContext.broadcast({r["doc_id"]: r["toxic"] for r in labelled})  # at most `rows` numbers

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Terms()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            at = [i for i, d in enumerate(ids) if d in chosen.value]
            found = [terms_of(t, cache) for t in raw(batch.column("text").take(pa.array(at, pa.int64())))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in at], pa.int64()), pa.array([chosen.value[ids[i]] for i in at], pa.int32()),
                 pa.array([len(t) for t in found], pa.int64()), pa.array([t.tobytes() for t in found], pa.binary())],
                ["doc_id", "toxic", "n", "terms"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(pick, "doc_id long, toxic int, n long, terms binary").groupBy("doc_id").agg(F.min(F.struct("n", "terms", "toxic")).alias("t"))
    picked = durable(picked.select(F.xxhash64("doc_id").alias("place"), "doc_id", "t.toxic", "t.n", "t.terms"), "toxicity-terms")
    sizes = sorted((r["place"], r["doc_id"], r["n"]) for r in picked.select("place", "doc_id", "n").collect())
    fits = int((np.cumsum([n for _, _, n in sizes]) <= terms).sum())
    if not fits:
        return picked.limit(0)
    place, doc_id = (F.lit(x).cast("long") for x in sizes[fits - 1][:2])
    return picked.where((F.col("place") < place) | (F.col("place") == place) & (F.col("doc_id") <= doc_id))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Machine:
    """Fit on the bounded sample. It is one task's work; the driver gets the machine alone."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        found = [np.frombuffer(t.as_buffer(), np.int32) for t in table.column("terms")]
        machine = fit_machine(found, table.column("toxic").to_numpy())
        return pa.table({"w0": pa.array([machine.w0]), "rows": pa.array([machine.rows.tobytes()], pa.binary())})

    row = sample(docs, labels, rows).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit, "w0 double, rows binary").first()
    if row is None:
        return fit_machine([], np.empty(0, np.int64))
    return Machine(row["w0"], np.frombuffer(row["rows"], np.float32).reshape(TERMS, FACTORS + 1))


def _scores(machine: Machine, batch: pa.RecordBatch, cache: Terms) -> np.ndarray:
    out = []
    texts = raw(batch.column("text"))
    for at in range(0, len(texts), 100):
        out.append(machine.scores([terms_of(t, cache) for t in texts[at:at + 100]]))
    return np.concatenate([*out, np.empty(0)])


def add_score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (0 to 1) as column ``name``; null and empty texts have the bias's."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Terms()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_scores(model.value, batch, cache), pa.float64())],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def drop_toxic(docs: DataFrame, machine: Machine, limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score is below ``limit``. No name of a column matters but ``text``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Terms()
        for batch in batches:
            yield batch.filter(pa.array(_scores(model.value, batch, cache) < limit))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(clean, docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    The score depends on the text alone; labels, language, source and id never
    enter it. Empty and null texts get the share of toxic documents, about. An
    empty table gives no rows; empty or null labels give scores below 0.5.
    Repeated rows get equal scores. Other columns are not read.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = add_score(slim, train(docs, labels)).drop("text")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
