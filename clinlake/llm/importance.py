"""Importance resampling towards a target distribution.

Features are runs of words hashed to buckets.  One pass counts the buckets of
the source rows, one those of the target rows; the gain of a bucket is its
smoothed log-ratio as a whole number, so a row's weight is an exact sum
looked up in one array of gains (fixed size: the buckets).  The weight plus
Gumbel noise from a hash of the id is the row's score, and the rows of the
highest scores are drawn: a draw without replacement in proportion to the
weights.

The lowest drawn score is found by selection, not by sorting every row: each
partition tells the median of its remaining keys and how many remain; the
median of the medians, weighted by those numbers, has at least a quarter of
the remaining keys on either side, so every round drops at least a quarter
until the exact cutoff key is found.  Only the winners are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import runs, stages, text
from clinlake.operators.ranking import ROWS_PER_BUCKET, running_total

BUCKETS = 10_000
#: A remainder of so many keys is sorted at once.
FEW = 4096
#: Remaining keys are stored anew when they are at most this share of the table read.
SHRINK = 8
MAX_ID = np.iinfo(np.int64).max

_KEY = ("neg", "id", "tie")


def _buckets(texts: list[bytes], length: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: the bucket of every run of one to ``length`` words and the
    text it is of, and the texts of the piece's own words."""
    for w in runs.words(texts, length - 1):
        crc, owner = zip(*[runs.run_crc32(w, n) for n in range(1, length + 1)])
        yield np.concatenate(crc).astype(np.int64) % buckets, np.concatenate(owner), w.owner[w.begins]


def bucket_counts(rows: DataFrame, text_col: str = "text", length: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket.  Every task sends at most one row a
    bucket; the driver gets at most ``buckets`` rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in text.pieces(batches):
            for bucket, _, _ in _buckets(text.utf8(b.column("text")), length, buckets):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    found = (rows.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # bounded: one row a bucket
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(P(bucket in target) / P(bucket in source))), each count raised by one."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", length: int = 1) -> DataFrame:
    """``(id, n_words, n_features, weight, tie)`` of every row; ``tie`` is a hash of the text."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("tie"))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "n_words", "n_features", "weight", "tie")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text.pieces(batches):
            texts = text.utf8(b.column("text"))
            n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for bucket, owner, of_word in _buckets(texts, length, len(gain)):
                n_words += np.bincount(of_word, minlength=len(texts))
                n_features += np.bincount(owner, minlength=len(texts))
                np.add.at(weight, owner, gain[bucket])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n_words), pa.array(n_features), pa.array(weight), b.column("tie")],
                                             schema.fieldNames())

    return rows.mapInArrow(add, schema)


def noise(id_col: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(``<seed>:<id>``); a null id counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    u = (h.cast("long").cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def _before(key: tuple, strictly: bool = True) -> Column:
    """Keys in front of ``key``; the first comparison alone reaches the scan."""
    neg, here, lit = F.col("neg"), F.struct(*_KEY), F.struct(*[F.lit(int(x)).cast("long") for x in key])
    return (neg <= key[0]) & (here < lit if strictly else here <= lit)


def _behind(key: tuple) -> Column:
    return (F.col("neg") >= key[0]) & (F.struct(*_KEY) > F.struct(*[F.lit(int(x)).cast("long") for x in key]))


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lower median of the keys of this partition, and how many there are."""
    parts = [[b.column(c).to_numpy() for c in _KEY] for b in batches if b.num_rows]
    if parts:
        keys = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort(keys[::-1])
        mid = order[(len(order) - 1) // 2]
        yield pa.RecordBatch.from_arrays([pa.array([int(k[mid])]) for k in keys] + [pa.array([len(order)])], [*_KEY, "n"])


def weighted_median(found: list[tuple[tuple, int]]) -> tuple:
    """The first key, in order, at which half of all weight is reached."""
    half, upto = sum(n for _, n in found) / 2, 0
    for key, n in sorted(found):
        upto += n
        if upto >= half:
            return key
    raise ValueError("no keys")


def kth_key(keys: DataFrame, k: int, few: int = FEW) -> tuple | None:
    """The ``k``-th key ``(neg, id, tie)`` in ascending order of a stored table
    of non-null keys, equal keys counted each; None if there are fewer or k < 1."""
    left = rows = keys.count()
    if not 1 <= k <= left:
        return None
    left_keys, own = keys.select(*_KEY), None
    try:
        while left > few:
            if SHRINK * left <= rows:
                smaller = stages.store(left_keys, "selection")
                if own is not None:
                    stages.remove(own)
                own, left_keys, rows = smaller, smaller, left
            found = left_keys.mapInArrow(_medians, "neg long, id long, tie long, n long").collect()  # bounded: one row a partition
            pivot = weighted_median([((r["neg"], r["id"], r["tie"]), r["n"]) for r in found])
            less, upto = left_keys.agg(F.count_if(_before(pivot)), F.count_if(_before(pivot, strictly=False))).first()
            if k <= less:
                left_keys, left = left_keys.where(_before(pivot)), less
            elif k <= upto:
                return pivot
            else:
                left_keys, left, k = left_keys.where(_behind(pivot)), left - upto, k - upto
        return tuple(left_keys.orderBy(*_KEY).limit(k).collect()[-1])  # bounded: at most ``few`` rows
    finally:
        if own is not None:
            stages.remove(own)


def resample(docs: DataFrame, target: DataFrame, per_hundred: int = 10, min_words: int = 20, seed: str = "2024",
             length: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", few: int = FEW) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every row of ``docs``.

    Of the N rows with at least ``min_words`` words, floor(``per_hundred`` N /
    100) are drawn: those of the highest scores, ties to the smaller id (null
    last), then by a hash of the text.  ``rank`` counts them from 1 and is null
    for all others.  ``per_hundred`` is a whole number.

    Null and empty texts have no features and weight 0.  Repeated rows count
    each, in the statistics and in the draw (of wholly equal rows any may get
    the smaller rank).  An empty target leaves all gains to the source's own
    counts; an empty ``docs`` gives an empty result.  Other columns are not read.
    """
    gain = gains(bucket_counts(docs, text_col, length, buckets), bucket_counts(target, target_text_col, length, buckets))
    weighed = weigh(docs, gain, id_col, text_col, length).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = stages.store(weighed.withColumn("neg", -F.col("score")).withColumnRenamed("id", "given")
                          .withColumn("id", F.coalesce("given", F.lit(int(MAX_ID)))), "importance")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * per_hundred // 100
    cut = kth_key(scored.where(able), drawn, few)
    shown = [F.col("given").alias("id"), "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*shown, none)
    wins = able & _before(cut, strictly=False)
    ranked = running_total(scored.where(wins).withColumn("one", F.lit(1).cast("long")), _KEY, ["one"],
                           n_buckets=max(1, -(-drawn // ROWS_PER_BUCKET)))
    # Of rows equal to the cutoff key, only as many as are still to be drawn.
    rank = F.when(F.col("cum_one") <= drawn, F.col("cum_one")).alias("rank")
    return ranked.select(*shown, rank).unionByName(scored.where(~wins).select(*shown, none))
