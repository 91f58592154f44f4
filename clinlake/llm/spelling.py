"""Spelling variants: words one edit apart, found in a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word.  If two
words are one edit apart, their reduced words are equal or one edit apart.
Each word's reduced word is joined to the full one-edit neighbourhoods (every
replacement, deletion and insertion of a symbol) of all reduced words, both by
a 64-bit key, and what meets is compared letter by letter on the original
words.  Of the two neighbourhoods that hold a pair, the one of the smaller key
sends it, so every pair is met once.

The number of symbols grows slowly with the vocabulary, so that a reduced word
stands for a few words at every size.  Where very many words share a reduced
word all the same, they are not compared pair by pair: words of equal length
meet by what is left when one place is taken out, words of neighbouring
lengths by the longer one's deletions, which gives near words only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import runs, stages, text
from clinlake.llm.substring import _runs

U64 = np.uint64
MIN_LENGTH = 7
MIN_COUNT = 2
DELETE_ONE_IN = 31
#: Distinct words that a task holds before it sends them on.
HELD_WORDS = 200_000
#: Words of one batch whose neighbourhoods are made at once, and bytes of one bucket.
BATCH_LETTERS = 1 << 15
BUCKET_BYTES = 32 << 20
#: Candidate pairs compared at once; reduced words that make more pairs than this go the other way.
PAIRS_AT_ONCE = 1 << 19
CROWDED = 1 << 16

_BASE = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(int(_BASE), -1, 2**64))
_LONGER = U64(0xD6E8FEB86659FD93)
_WORDS = "word string, n long"
_SENT = "bucket int, data binary"
_NEAR = "a string, b string, n_a long, n_b long"

# Letters are A-Z, a-z and U+00C0 to U+00FF: in UTF-8 the byte 0xC3 and the one behind it.
_ASCII = text.byte_table((0x41, 0x5A), (0x61, 0x7A))
_OTHER = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


# ---- words

def _pieces(body: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at an ASCII character that is no letter."""
    at = 0
    while at < len(body):
        cut = _OTHER.search(body, min(len(body), at + text.SLICE_BYTES))
        end = cut.end() if cut else len(body)
        yield body[at:end]
        at = end


def _counted(texts: list[bytes], keys: list[bytes]) -> pa.StructArray:
    """The words of texts (see `vocabulary`) with their numbers; ``keys`` are the ids as text."""
    buf, begins = text.joined(texts)
    buf = text.FOLD[buf]
    lead = buf == 0xC3
    tail = np.append(False, lead[:-1])
    starts, ends = _spans(_ASCII[buf] | lead | tail)
    upto = np.append(0, np.cumsum(~tail))  # code points in front of each byte
    size = upto[ends] - upto[starts]
    long = size >= MIN_LENGTH
    starts, ends, size = starts[long], ends[long], size[long]
    owner = np.searchsorted(begins, starts, "right") - 1
    seeds = np.frombuffer(b"".join(keys) or b"\0", np.uint8)
    edge = np.append(0, np.cumsum([len(k) for k in keys]))
    h = runs.crc32(buf, starts, ends, runs.crc32(seeds, edge[:-1], edge[1:])[owner])
    cut = h % DELETE_ONE_IN == 0
    left = ~cut | (size > MIN_LENGTH)
    edges = np.zeros(len(buf) + 1, np.int8)  # words never touch: a run ends at its separator
    edges[starts[left]], edges[ends[left]] = 1, -1
    keep = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    gone = np.flatnonzero(cut & left)
    point = np.flatnonzero(~tail)[upto[starts[gone]] + h[gone].astype(np.int64) % size[gone]]
    keep[point] = False
    keep[point[lead[point]] + 1] = False
    bytes_upto = np.append(0, np.cumsum(keep))
    offsets = np.append(0, bytes_upto[ends[left]]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(buf[keep])])
    return pc.value_counts(words)


def _spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their numbers, added up within the task while they are few."""
    held, rows = [], 0

    def added() -> pa.Table:
        table = pa.Table.from_batches(held)
        return table.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for b in text.pieces(batches):
        texts, keys = text.utf8(b.column("text")), [f"{i}:".encode() for i in b.column("key").to_pylist()]
        for lo, hi in text.slices(texts):
            parts = [(texts[lo:hi], keys[lo:hi])] if hi - lo > 1 else [([p], keys[lo:hi]) for p in _pieces(texts[lo])]
            for some, of in parts:
                found = _counted(some, of)
                held.append(pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"]))
                rows += len(found)
        if rows > HELD_WORDS:
            table = added()
            held, rows = table.to_batches(), table.num_rows
            if rows > HELD_WORDS // 2:
                yield from held
                held, rows = [], 0
    if held:
        yield from added().to_batches()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: the distinct words of at least seven letters that occur at least twice.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.
    Where 31 divides h, the crc32 of ``<id>:<run>``, the run loses its letter h
    % length.  Null texts have no words; a null id counts as empty.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_count, _WORDS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# ---- reduced words and their neighbourhoods

def symbols_for(words: int) -> int:
    """How many symbols letters are hashed to: the ninth root of the vocabulary, three at least."""
    return max(3, round(words ** (1 / 9)))


def reduce_letters(letters: np.ndarray, symbols: int) -> np.ndarray:
    """The symbol of each letter (a Latin-1 byte)."""
    return (((letters.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(7)) % np.uint32(symbols)).astype(np.int64)


def _values(n: int) -> np.ndarray:
    return text.mix(np.arange(1, n + 1, dtype=U64) * _LONGER) | U64(1)


def _key(total: np.ndarray, length: int) -> np.ndarray:
    return text.mix(total + U64(length * int(_LONGER) % 2**64))


def neighbourhood(reduced: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For reduced words of one length (one row each): their own keys, and
    (row, key) of every distinct reduced word one edit away."""
    n, length = reduced.shape
    value = _values(symbols)
    power = np.multiply.accumulate(np.append(U64(1), np.full(length + 1, _BASE, U64)))
    term = value[reduced] * power[:length]
    upto = np.zeros((n, length + 1), U64)
    np.cumsum(term, axis=1, out=upto[:, 1:])
    total = upto[:, -1:]
    new = np.ones((n, length), bool)  # a run of one symbol has one deletion
    new[:, 1:] = reduced[:, 1:] != reduced[:, :-1]
    found = [(new, _key(upto[:, :-1] + (total - upto[:, 1:]) * _BACK, length - 1))]
    for c in range(symbols):
        other = reduced != c
        found.append((other, _key(total - term + value[c] * power[:length], length)))
        # An insertion in front of its own symbol is the same as one behind it.
        found.append((np.append(other, np.ones((n, 1), bool), axis=1), _key(upto + value[c] * power[:length + 1] + (total - upto) * _BASE, length + 1)))
    rows = np.concatenate([np.nonzero(ok)[0] for ok, _ in found])
    return _key(total[:, 0], length), rows, np.concatenate([key[ok] for ok, key in found])


def _sender(symbols: int, buckets: int):
    shift = U64(32)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bucket of keys: words under their own keys (kind 0) and under those of their neighbourhoods (kind 1)."""
        for b in batches:
            words, n = [w.encode("latin-1") for w in b.column("word").to_pylist()], b.column("n").to_numpy()
            size = np.array([len(w) for w in words], np.int64)
            for length in np.unique(size).tolist():
                mine = np.flatnonzero(size == length)
                step = max(1, BATCH_LETTERS // length)
                for lo in range(0, len(mine), step):
                    some = mine[lo:lo + step]
                    letters = np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), length)
                    own, row, key = neighbourhood(reduce_letters(letters, symbols), symbols)
                    first = key > own[row]
                    row, key = np.concatenate([np.arange(len(some)), row[first]]), np.concatenate([own, key[first]])
                    kind = np.ones(len(row), np.uint8)
                    kind[:len(some)] = 0
                    bucket = ((key >> shift) * U64(buckets)) >> shift
                    order = np.argsort(bucket, kind="stable")
                    row, key, kind = row[order], key[order], kind[order]
                    edge = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=U64))
                    used = np.flatnonzero(np.diff(edge))
                    data = [_pack(letters[row[x:y]], n[some][row[x:y]], key[x:y], kind[x:y])
                            for x, y in zip(edge[used].tolist(), edge[used + 1].tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(data, pa.binary())], ["bucket", "data"])

    return send


def _pack(letters: np.ndarray, n: np.ndarray, key: np.ndarray, kind: np.ndarray) -> bytes:
    head = np.array(letters.shape, np.int64).tobytes()
    return b"".join([head, key.tobytes(), n.astype(np.int64).tobytes(), kind.tobytes(), np.ascontiguousarray(letters).tobytes()])


def _unpack(data: bytes):
    rows, length = np.frombuffer(data, np.int64, 2).tolist()
    at = 16 + 16 * rows
    return (np.frombuffer(data, np.uint8, rows * length, at + rows).reshape(rows, length), np.frombuffer(data, np.int64, rows, 16 + 8 * rows),
            np.frombuffer(data, U64, rows, 16), np.frombuffer(data, np.uint8, rows, at))


# ---- verification

def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words of each row (one letter a column) are exactly one edit apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] < b.shape[1]:
        a, b = b, a
    if a.shape[1] != b.shape[1] + 1:
        return np.zeros(len(a), bool)
    front = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return front + back >= b.shape[1]


def _totals(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per letter its part of the word's polynomial, and the sums in front of each letter and of all."""
    length = letters.shape[1]
    term = _values(256)[letters] * np.multiply.accumulate(np.append(U64(1), np.full(length, _BASE, U64)))[:length]
    upto = np.zeros((len(letters), length + 1), U64)
    np.cumsum(term, axis=1, out=upto[:, 1:])
    return term, upto


def crowd(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of words of ``a`` with words of ``b`` without comparing all
    of them; ``b`` are as long as those of ``a``, or one letter shorter.  What
    shares a key is near, so the work follows the words and the pairs found."""
    term, upto = _totals(a)
    if a.shape[1] == b.shape[1]:
        places = np.arange(a.shape[1], dtype=U64)
        other, whole = _totals(b)
        mine = text.mix(upto[:, -1:] - term) + places  # one place taken out
        theirs = text.mix(whole[:, -1:] - other) + places
        keep = np.ones(mine.shape, bool)
    else:
        mine = upto[:, :-1] + (upto[:, -1:] - upto[:, 1:]) * _BACK
        keep = np.ones(mine.shape, bool)
        keep[:, 1:] = a[:, 1:] != a[:, :-1]
        theirs = _totals(b)[1][:, -1:]
    x, y = _meet(mine[keep], theirs.reshape(-1))
    x, y = np.nonzero(keep)[0][x], y // theirs.shape[1]
    ok = one_edit(a[x], b[y])
    return x[ok], y[ok]


def _meet(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with equal keys."""
    order = np.argsort(right, kind="stable")
    lo, hi = (np.searchsorted(right[order], left, side) for side in ("left", "right"))
    return _pairs(lo, hi - lo, order)


def _pairs(lo: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each left place with its ``size`` right ones, which stand from ``lo`` on in ``order``."""
    x = np.repeat(np.arange(len(lo)), size)
    return x, order[np.arange(len(x)) - np.repeat(np.cumsum(size) - size - lo, size)]


def _compare(a: np.ndarray, b: np.ndarray, key_a: np.ndarray, key_b: np.ndarray, among: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of words with equal keys; ``among``: ``b`` is ``a`` itself and each pair comes once."""
    order = np.argsort(key_b, kind="stable")
    ordered = key_b[order]
    lo, hi = (np.searchsorted(ordered, key_a, side) for side in ("left", "right"))
    size = hi - lo
    # How many words of ``a`` meet the same ones of ``b``.
    _, back, mates = np.unique(key_a, return_inverse=True, return_counts=True)
    crowded = mates[back] * size > CROWDED
    for k in np.unique(key_a[crowded]):
        some, others = np.flatnonzero(key_a == k), order[np.searchsorted(ordered, k, "left"):np.searchsorted(ordered, k, "right")]
        swap = a.shape[1] < b.shape[1]
        x, y = crowd(b[others], a[some])[::-1] if swap else crowd(a[some], b[others])
        x, y = some[x], others[y]
        yield (x[x < y], y[x < y]) if among else (x, y)
    size[crowded] = 0
    upto = np.cumsum(size)
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE)))
        x, y = _pairs(lo[at:end], size[at:end], order)
        x += at
        if among:
            x, y = x[x < y], y[x < y]
        ok = one_edit(a[x], b[y])
        yield x[ok], y[ok]
        at = end


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: words whose reduced words meet, compared on their own letters."""
    for _, run in groupby(_runs(batches, "bucket"), key=lambda x: x[0]):
        by_length: dict[int, list] = {}
        for _, part in run:
            for data in part.column("data").to_pylist():
                found = _unpack(data)
                by_length.setdefault(found[0].shape[1], []).append(found)
        sets = {}
        for length, found in by_length.items():
            letters, n, key, kind = (np.concatenate(x) for x in zip(*found))
            sets[length] = [(letters[kind == k], n[kind == k], key[kind == k]) for k in (0, 1)]
        by_length.clear()
        for length, (own, sent) in sets.items():
            for to in (length - 1, length, length + 1):
                if to in sets:
                    other = sets[to][0]
                    for x, y in _compare(sent[0], other[0], sent[2], other[2], False):
                        yield from _near(sent, other, x, y)
            for x, y in _compare(own[0], own[0], own[2], own[2], True):
                yield from _near(own, own, x, y)


def _near(a: tuple, b: tuple, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(x):
        yield pa.RecordBatch.from_arrays([_strings(a[0][x]), _strings(b[0][y]), pa.array(a[1][x]), pa.array(b[1][y])], ["a", "b", "n_a", "n_b"])


def _strings(letters: np.ndarray) -> pa.Array:
    size = letters.shape[1]
    whole = np.ascontiguousarray(letters).tobytes().decode("latin-1")
    return pa.array([whole[i:i + size] for i in range(0, len(whole), size)], pa.string())


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """``(a, b, n_a, n_b)``: every pair of words of ``words`` (distinct, letters
    up to U+00FF; a stored table) that are exactly one edit apart, once."""
    n, letters = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("word")), F.lit(0))).first()
    symbols = symbols or symbols_for(n)
    sent = symbols * letters * (17 + letters / max(1, n))
    buckets = max(stages.tasks(words.sparkSession), int(sent // BUCKET_BYTES) + 1)
    dealt = words.mapInArrow(_sender(symbols, buckets), _SENT).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_verify, _NEAR)


# ---- forms and roots

def variants(docs: DataFrame, ratio: int = 10, symbols: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of `vocabulary`.

    ``n_near`` counts the words one edit away (one letter inserted, deleted or
    replaced).  ``form`` is the one of largest ``n`` among them (ties: smallest
    in code-point order) if its ``form_n`` is at least ``ratio`` (2 or more)
    times ``n``, else both are null.  ``root`` is where the forms lead in the
    end, the word itself if it has none.

    Null and empty texts and empty tables add no words.  Repeated rows count
    each.  Other columns than id and text are not read.
    """
    words = stages.store(vocabulary(docs, id_col, text_col), "spelling-words")
    near = near_pairs(words, symbols)
    seen = (near.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))).alias("r"))
        .select("r.*").unionByName(words, allowMissingColumns=True))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("n"), "other"))).alias("best")
    known = seen.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best)
    has = -F.col("best.n") >= ratio * F.col("n")
    formed = stages.store(known.select("word", F.when(has, F.col("best.other")).alias("form"), "n", "n_near",
                                       F.when(has, -F.col("best.n")).alias("form_n")), "spelling-forms")
    stages.remove(words)
    roots = follow(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def follow(steps: DataFrame) -> DataFrame:
    """``(word, root)`` where each word's steps end.  Every round doubles the
    steps taken and is stored; a form is ``ratio`` times as frequent as its
    word, so chains are short."""
    steps = stages.store(steps, "spelling-roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = stages.store(steps.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "spelling-roots")
        stages.remove(steps)
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps
