"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, pairs of neighbouring words and pairs of words
with one between them, each hashed to one of ``BUCKETS`` coordinates.  The
model is learned from a bounded sample of labelled rows: their coordinates are
worked out by all tasks and stored, and each pass of the learner is one task
that streams over that table, row by row, with a learning rate of its own for
every coordinate, and stores its state for the next pass.  L1 keeps every coordinate at exactly zero whose evidence
stays small, so the finished weights are a short list: it travels to the
tasks that score whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import runs, stages, text

U64 = np.uint64
BITS = 20
BUCKETS = 1 << BITS
#: Coordinates of a stored state in one row.
PIECE = 1 << 16
_SALT = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9))


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per piece: coordinates of words, pairs and pairs over one word, and the text of each (repeats included)."""
    for w in runs.words(texts, 2):
        word = text.span_hash(w.buf, w.starts, w.ends)
        owners, hashes = [w.owner[w.begins]], [text.mix(word[w.begins] * _SALT[0])]
        for gap in (1, 2):
            at = np.flatnonzero(w.begins & (np.arange(len(word)) + gap < w.until))
            hashes.append(text.mix(word[at] * _SALT[gap] + word[at + gap]))
            owners.append(w.owner[at])
        yield (np.concatenate(hashes) >> U64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def coordinates(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct coordinates of each text, ascending."""
    pairs = _distinct([owner * BUCKETS + at for at, owner in features(texts)])
    edge = np.searchsorted(pairs, np.arange(len(texts) + 1) * BUCKETS)
    return [pairs[lo:hi] % BUCKETS for lo, hi in zip(edge[:-1], edge[1:])]


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """Ascending (text, coordinate) pairs; only pieces of one long text can share any."""
    pairs = np.sort(np.concatenate([_plain(np.sort(x)) for x in pairs])) if pairs else np.empty(0, np.int64)
    return _plain(pairs)


def _plain(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]]


@dataclass
class Ftrl:
    """State of the learner: per coordinate the sum ``z`` and the squared
    gradients ``n``; the last entry is the bias, which L1 leaves alone."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1

    def _weights(self, z: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Weights of coordinates that end with the bias, from their states."""
        over = np.abs(z) - self.l1
        over[-1] = np.abs(z[-1])
        return -np.sign(z) * np.maximum(over, 0.0) / ((self.beta + root) / self.alpha + self.l2)

    def weights(self) -> np.ndarray:
        return self._weights(self.z, np.sqrt(self.n))

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        """One row: its coordinates, the label 0 or 1, and what the row counts."""
        at = np.append(at, BUCKETS)
        z, n = self.z[at], self.n[at]
        root = np.sqrt(n)
        w = self._weights(z, root)
        g = (sigmoid(w.sum()) - label) * weight
        n += g * g
        self.z[at] = z + g - (np.sqrt(n) - root) / self.alpha * w
        self.n[at] = n


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


@dataclass
class Model:
    """The coordinates with a weight other than zero, and the bias."""

    at: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.at] = self.weight
        return out

    def scores(self, texts: list[bytes], dense: np.ndarray) -> np.ndarray:
        """Probability of the label 1 of each whole text; a coordinate counts once a text."""
        found = []
        for at, owner in features(texts):
            used = dense[at] != 0
            found.append(owner[used] * BUCKETS + at[used])
        pairs = _distinct(found)
        return sigmoid(np.bincount(pairs // BUCKETS, dense[pairs % BUCKETS], len(texts)) + self.bias)


def sample(docs: DataFrame, labels: DataFrame, limit: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(label, share, place, data)``: labelled rows and their coordinates.

    At most ``limit`` ids, half of them of either label at most, those of the
    least hashes (both labels in full where they fit); ``share`` is how many
    ids of its label each stands for, over the same for both labels together.
    An id labelled twice has the larger label, and of several rows of one id
    the one of the least text is used.  Null labels, ids and texts are left out.
    """
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    known = labels.select(i.cast("long").alias("id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("label"))
    known = known.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    size = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # bounded: two rows
    place = F.xxhash64("id")
    # Rows outside a share of about the limit are left out before any are ordered.
    parts = [known.where((F.col("label") == y) & (F.pmod(place, F.lit(max(1, n))) < limit)).select("id", "label", place.alias("place"))
             .orderBy("place", "id").limit(limit // 2) for y, n in sorted(size.items())]
    if not parts:
        parts = [known.select("id", "label", place.alias("place"))]
    ids = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    share = {y: n / min(n, max(1, limit // 2)) for y, n in size.items()}
    mean = sum(share[y] * min(size[y], limit // 2) for y in size) / max(1, sum(min(n, limit // 2) for n in size.values()))
    rows = (docs.select(i.cast("long").alias("id"), t.cast("string").alias("text")).where("text is not null")
            .join(F.broadcast(ids), "id")  # bounded: ``limit`` ids
            .groupBy("id", "label", "place").agg(F.min("text").alias("text")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text.pieces(batches, 256):
            found = [x.astype(np.uint32).tobytes() for x in coordinates(text.utf8(b.column("text")))]
            heft = [share[y] / mean for y in b.column("label").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(heft, pa.float64()), b.column("place"), b.column("id"),
                                              pa.array(found, pa.binary())], ["label", "share", "place", "id", "data"])

    return rows.mapInArrow(hashed, "label int, share double, place long, id long, data binary")


_STATE = "at binary, z binary, n binary"


def _pieces(ftrl: Ftrl) -> Iterator[pa.RecordBatch]:
    """The used coordinates of a state, ``PIECE`` at a time."""
    used = np.flatnonzero(ftrl.n)
    for lo in range(0, len(used), PIECE):
        at = used[lo:lo + PIECE]
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.uint32), ftrl.z[at], ftrl.n[at])], ["at", "z", "n"])


def _restore(ftrl: Ftrl, at: bytes, z: bytes, n: bytes) -> None:
    place = np.frombuffer(at, np.uint32)
    ftrl.z[place], ftrl.n[place] = np.frombuffer(z), np.frombuffer(n)


def fit(docs: DataFrame, labels: DataFrame, limit: int = 40_000, passes: int = 3, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", **options) -> Model:
    """Learn from at most ``limit`` labelled rows in ``passes`` passes over
    them (see `sample`); ``options`` are those of `Ftrl`.

    Every pass is one task over the stored sample in an order given by a hash,
    so a lost task repeats to the same state.  Between passes the state is a
    table; the driver gets the finished weights alone.  Without labelled rows
    the model scores everything 0.5.
    """
    def empty() -> Ftrl:
        return Ftrl(np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), **options)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = empty()
        for b in text.pieces(batches, 256):
            for y, heft, data, at, z, n in zip(*[b.column(c).to_pylist() for c in ("label", "share", "data", "at", "z", "n")]):
                if at is not None:  # the state, in front of all rows
                    _restore(ftrl, at, z, n)
                else:
                    ftrl.learn(np.frombuffer(data, np.uint32).astype(np.int64), y, heft)
        yield from _pieces(ftrl)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = empty()
        for b in batches:
            for r in b.to_pylist():
                _restore(ftrl, r["at"], r["z"], r["n"])
        w = ftrl.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "weight"])

    rows = stages.store(sample(docs, labels, limit, id_col, text_col, label_col), "toxicity-sample")
    state = docs.sparkSession.createDataFrame([], _STATE)
    for turn in range(passes):
        every = (state.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)).withColumn(
            "o", F.xxhash64("place", F.lit(turn))), allowMissingColumns=True))
        before, state = state, stages.store(every.repartition(1).sortWithinPartitions("kind", "o", "id").mapInArrow(learn, _STATE), "toxicity-state")
        if turn:
            stages.remove(before)
    found = state.repartition(1).mapInArrow(weigh, "at long, weight double").collect()  # bounded: weights that are not zero
    stages.remove(rows)
    stages.remove(state)
    bias = sum(r["weight"] for r in found if r["at"] == BUCKETS)
    known = sorted((r["at"], r["weight"]) for r in found if r["at"] < BUCKETS)
    return Model(np.array([at for at, _ in known], np.int64), np.array([w for _, w in known], float), float(bias))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (all columns of ``docs``) and ``score``, the probability that it is toxic.

    Whole texts are read and nothing but the text.  Null and empty texts, and
    texts without words, get the score of the bias alone; repeated rows give
    repeated results and an empty table an empty one.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = model.dense()
        for b in text.pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(model.scores(text.utf8(b.column("text")), dense))], ["row", "score"])

    return rows.mapInArrow(predict, schema)


def fold(id_col: Column, folds: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text modulo ``folds``; null ids have none."""
    return F.crc32(id_col.cast("string")) % folds
