"""Removal of exact repeats: fixed-block anchors, rolling probes, extension.

A *window* is ``window`` consecutive words.  Every word that lies in a window
whose word sequence also starts earlier (smaller id, or same document and
earlier start) is removed.

Method.  Each document is cut into non-overlapping blocks of ``window // 2``
words; these aligned blocks are the index.  Every rolling run of that many
words, in every document, probes the index.  A window that occurs twice holds
a whole aligned block of either occurrence, so both occurrences are hit: the
anchors lose nothing.  Hits are then extended: the windows around hit runs
are compared by a 96-bit hash, the earliest occurrence of each is found,
and runs of consecutive repeated windows form the maximal repeats that go.

Distribution.  Documents are dealt to batches by a hash of id and text, about
``BATCH_BYTES`` of text each.  A batch sends each distinct key once, however
often it holds it, so a passage that a third of all documents share costs one
entry per batch.  Keys are dealt to buckets by their leading bits; a bucket
answers each batch with the keys that matter there.  Three passes over the
texts follow one another (probe, extend, cut), each with its answers stored in
the shared folder, and nothing but two sizes reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import stages, text

BATCH_BYTES = 8 << 20
BUCKET_KEYS = 1 << 21
FINGERPRINT_BITS = 38
MAX_ID = np.iinfo(np.int64).max

U64 = np.uint64

_PROBE = "bucket int, batch long, data binary"
_REPLY = "batch long, data binary"
_EXTEND = "kind string, bucket int, batch long, data binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns as a struct),
    ``kept`` (the words that stay, joined by one space), ``n_words``,
    ``n_removed``, and ``rest``: the text as it was but for the removed words
    and the white space behind them (null where nothing is removed).

    Words are maximal runs of bytes other than space and 0x09-0x0D.  ``id_col``
    is an integer column.  A null or empty text has no words and gives an
    empty ``kept``.  A null id counts as the largest; rows of equal id are
    ordered by a hash of their text; rows equal in id and text share a place,
    so none of them is earlier than the other.  An empty table gives an empty
    result.  Other columns, whatever their names, are carried in ``row``.
    """
    spark = docs.sparkSession
    size = stages.text_bytes(docs, text_col)
    n_batches = max(1, -(-size // BATCH_BYTES))
    # A word and its separator are two bytes at least, and about six in prose.
    bits = min(20, max(2, int(np.ceil(np.log2(max(1, size / 6 / BUCKET_KEYS)))) + 1))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(int(MAX_ID))).alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("tkey", F.xxhash64("text"))
    keyed = keyed.withColumn("batch", F.pmod(F.xxhash64("id", "tkey"), F.lit(n_batches)))
    slim = keyed.select("batch", "id", "tkey", "text")
    parts = max(stages.tasks(spark), min(n_batches, 8192))

    probes = _dealt(slim, None, parts).mapInArrow(_prober(window, bits), _PROBE)
    hits = stages.store(_by_bucket(probes, bits, spark).mapInArrow(_match, _REPLY), "repeat-hits")

    extended = stages.store(
        _dealt(slim, hits, parts).mapInArrow(_extender(window, bits), _EXTEND), "repeat-windows", "kind")
    stages.remove(hits)
    later = _by_bucket(extended.where("kind = 'window'").select("bucket", "batch", "data"), bits, spark)
    cuts = stages.store(later.mapInArrow(_later(window), _REPLY).unionByName(
        extended.where("kind = 'cut'").select("batch", "data")), "repeat-cuts")
    stages.remove(extended)

    schema = T.StructType([keyed.schema["row"], T.StructField("kept", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("rest", T.StringType())])
    # A text column travels once, inside its row.
    inside = docs.schema[text_col].dataType == T.StringType()
    whole = _dealt(keyed.select("batch", "id", "tkey", "row", *([] if inside else ["text"])), cuts, parts)
    return whole.mapInArrow(_cutter(docs.columns.index(text_col) if inside else None), schema)


def _by_bucket(entries: DataFrame, bits: int, spark) -> DataFrame:
    return entries.repartition(max(stages.tasks(spark), 1 << bits), "bucket").sortWithinPartitions("bucket")


def _dealt(docs: DataFrame, replies: DataFrame | None, parts: int) -> DataFrame:
    """Documents dealt by batch, in (id, text) order, behind the batch's replies."""
    docs = docs.withColumn("data", F.lit(None).cast("binary"))
    if replies is not None:
        docs = docs.unionByName(replies, allowMissingColumns=True)
    return (docs.repartition(parts, "batch")
            .sortWithinPartitions("batch", F.col("data").isNull(), F.col("id"), F.col("tkey")))


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Consecutive rows of equal ``key``, cut where Arrow batches end."""
    for b in text.pieces(batches):
        k = b.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            yield int(k[lo]), b.slice(lo, hi - lo)


def _split(part: pa.RecordBatch) -> tuple[list[bytes], pa.RecordBatch]:
    """The replies at the head of a run, and its documents."""
    data = part.column("data")
    n = part.num_rows - data.null_count
    return data.slice(0, n).to_pylist(), part.slice(n)


def _rows(names: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    pairs = [x.split() for x in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, pairs)], [n for n, _ in pairs])


# ---- probe -------------------------------------------------------------------------------------

def _five(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _keys(words: np.ndarray, block: int, bits: int) -> np.ndarray:
    return text.rolling(words, block) >> U64(64 - bits - FINGERPRINT_BITS)


def _places(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document index and word position of each word of a slice."""
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(first[:-1] - first[0], counts)


def _prober(window: int, bits: int):
    block = window // 2

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in groupby(_runs(batches, "batch"), key=lambda x: x[0]):
            seen = []
            for _, part in run:
                texts = text.utf8(part.column("text"))
                for lo, hi in text.slices(texts):
                    buf, s, e, first = text.word_spans(texts[lo:hi], text.WHITE_SPACE)
                    keys = _keys(text.span_hash(buf, s, e), block, bits)
                    if not len(keys):
                        continue
                    owner, place = _places(first)
                    whole = owner[:len(keys)] == owner[block - 1:]
                    aligned = (place[:len(keys)] % block == 0)
                    seen.append(((keys << U64(1)) | aligned.astype(U64))[whole])
            if not seen:
                continue
            v = np.sort(np.concatenate(seen))
            key = v >> U64(1)
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]) if len(key) else key)
            if not len(start):
                continue
            stop = np.append(start[1:], len(key))
            key = key[start]
            # Two flags ride along: several here, and one of them an aligned block.
            entry = ((key & U64((1 << FINGERPRINT_BITS) - 1)) << U64(2)) | ((stop - start > 1).astype(U64) << U64(1)) | (v[stop - 1] & U64(1))
            bucket = key >> U64(FINGERPRINT_BITS)
            edge = np.searchsorted(bucket, np.arange((1 << bits) + 1, dtype=U64))
            rows = [(b, batch, _five(entry[edge[b]:edge[b + 1]])) for b in np.flatnonzero(np.diff(edge)).tolist()]
            yield _rows(_PROBE, list(zip(*rows)))

    return probe


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: keys that occur twice at least and are an aligned block somewhere, for each batch that has them."""
    for bucket, run in groupby(_runs(batches, "bucket"), key=lambda x: x[0]):
        sources, sets = [], []
        for _, part in run:
            sources += part.column("batch").to_pylist()
            sets += [_from_five(d) for d in part.column("data").to_pylist()]
        entry = np.concatenate(sets)
        source = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(entry, kind="stable")
        entry, source = entry[order], source[order]
        key = entry >> U64(2)
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.add.reduceat(((entry >> U64(1)) & U64(1)).astype(np.int64) + 1, start) > 1
        aligned = np.maximum.reduceat(entry & U64(1), start) > 0
        hot = np.repeat(several & aligned, np.diff(np.append(start, len(key))))
        key, source = key[hot], source[hot]
        order = np.argsort(source, kind="stable")
        key, source = key[order], source[order]
        edge = np.searchsorted(source, np.arange(len(sets) + 1))
        head = int(bucket).to_bytes(4, "little")
        rows = [(sources[i], head + _five(key[edge[i]:edge[i + 1]])) for i in np.flatnonzero(np.diff(edge)).tolist()]
        if rows:
            yield _rows(_REPLY, list(zip(*rows)))


# ---- extend ------------------------------------------------------------------------------------

class _Hits:
    """The hit keys of a batch, with a bitmap in front of the sorted search."""

    BITS = 22

    def __init__(self, replies: list[bytes]):
        self.keys = np.sort(np.concatenate([np.empty(0, U64), *[
            _from_five(r[4:]) | (U64(int.from_bytes(r[:4], "little")) << U64(FINGERPRINT_BITS)) for r in replies]]))
        self.bitmap = np.zeros(1 << self.BITS, dtype=bool)
        self.bitmap[(self.keys & U64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = self.bitmap[(keys & U64((1 << self.BITS) - 1)).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(at):
            place = np.searchsorted(self.keys, keys[at])
            found[at] = self.keys[np.minimum(place, len(self.keys) - 1)] == keys[at]
        return found


def _pack_windows(ha, hb, doc, start, ids, tkeys) -> bytes:
    used, ordinal = np.unique(doc, return_inverse=True)
    head = np.array([len(ha), len(used)], dtype="<i8").tobytes()
    return b"".join([head, ids[used].astype("<i8").tobytes(), tkeys[used].astype("<i8").tobytes(), ha.astype("<u8").tobytes(),
                     hb.astype("<u4").tobytes(), ordinal.astype("<u4").tobytes(), start.astype("<u4").tobytes()])


def _unpack_windows(data: bytes):
    n, docs = np.frombuffer(data, "<i8", 2)
    at = 16
    out = []
    for kind, count in (("<i8", docs), ("<i8", docs), ("<u8", n), ("<u4", n), ("<u4", n), ("<u4", n)):
        out.append(np.frombuffer(data, kind, count, at))
        at += out[-1].nbytes
    ids, tkeys, ha, hb, ordinal, start = out
    return ha, hb, ids[ordinal], tkeys[ordinal], start.astype(np.int64)


def _pack_cuts(ids, tkeys, starts, ends) -> bytes:
    """Removed word ranges ``[start, end)``, ordered by document and start."""
    new = np.append(True, (ids[1:] != ids[:-1]) | (tkeys[1:] != tkeys[:-1]) | (starts[1:] > ends[:-1]))
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(ids)) - 1
    return np.stack([ids[start], tkeys[start], starts[start], ends[stop]]).astype("<i8").tobytes()


def _unpack_cuts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(4, -1)


def _grouped(ha: np.ndarray, hb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that brings equal windows together, and where each group starts."""
    order = np.argsort(ha, kind="stable")
    a, b = ha[order], hb[order]
    same = a[1:] == a[:-1]
    if np.any(same & (b[1:] != b[:-1])):
        order = np.lexsort((hb, ha))
        a, b = ha[order], hb[order]
    return order, np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))


def _extender(window: int, bits: int):
    block = window // 2

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in groupby(_runs(batches, "batch"), key=lambda x: x[0]):
            replies, hits, found, ids, tkeys, n_docs = [], None, [], [], [], 0
            for _, part in run:
                more, part = _split(part)
                replies += more
                if not part.num_rows or not replies:
                    continue
                hits = hits or _Hits(replies)
                ids.append(part.column("id").to_numpy())
                tkeys.append(part.column("tkey").to_numpy())
                texts = text.utf8(part.column("text"))
                for lo, hi in text.slices(texts):
                    for w in _candidates(texts[lo:hi], hits, window, block, bits):
                        found.append((*w[:2], w[2] + (n_docs + lo), w[3]))
                n_docs += part.num_rows
            if not found:
                continue
            ha, hb, doc, start = (np.concatenate(x) for x in zip(*found))
            found.clear()
            ids, tkeys = np.concatenate(ids), np.concatenate(tkeys)
            order, first = _grouped(ha, hb)
            size = np.diff(np.append(first, len(order)))
            least = np.repeat(order[first], size)
            # Rows equal in id and text share a place.
            equal = (ids[doc[order]] == ids[doc[least]]) & (tkeys[doc[order]] == tkeys[doc[least]]) & (start[order] == start[least])
            cut = np.sort(order[~equal])
            if len(cut):
                d, s = doc[cut], start[cut]
                yield _rows(_EXTEND, [["cut"], [None], [batch], [_pack_cuts(ids[d], tkeys[d], s, s + window)]])
            lead = order[first]
            bucket = ha[lead] >> U64(64 - bits)
            edge = np.searchsorted(bucket, np.arange((1 << bits) + 1, dtype=U64))
            rows = []
            for b in np.flatnonzero(np.diff(edge)).tolist():
                at = lead[edge[b]:edge[b + 1]]
                rows.append(("window", b, batch, _pack_windows(ha[at], hb[at], doc[at], start[at], ids, tkeys)))
            yield _rows(_EXTEND, list(zip(*rows)))

    return extend


def _candidates(texts: list[bytes], hits: _Hits, window: int, block: int, bits: int):
    """Windows of the texts that hold a hit run: ``(hash, second hash, text index, start)``."""
    buf, s, e, first = text.word_spans(texts, text.WHITE_SPACE)
    if len(s) < window:
        return
    words = text.span_hash(buf, s, e)
    owner, place = _places(first)
    keys = _keys(words, block, bits)
    hit = hits(keys) & (owner[:len(keys)] == owner[block - 1:])
    upto = np.append(0, np.cumsum(hit))
    n = len(s) - window + 1
    span = window - block + 1
    at = np.flatnonzero((upto[span:span + n] > upto[:n]) & (owner[:n] == owner[window - 1:]))
    if len(at):
        ha = text.rolling(words, window, 3)[at]
        hb = (text.rolling(text.span_hash(buf, s, e, 4), window, 5)[at] >> U64(32)).astype(np.uint32)
        yield ha, hb, owner[at], place[at]


def _later(window: int):
    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bucket: each batch's leading windows that start earlier in another batch."""
        for _, run in groupby(_runs(batches, "bucket"), key=lambda x: x[0]):
            sources, sets = [], []
            for _, part in run:
                sources += part.column("batch").to_pylist()
                sets += [_unpack_windows(d) for d in part.column("data").to_pylist()]
            source = np.repeat(np.arange(len(sets)), [len(x[0]) for x in sets])
            ha, hb, ids, tkeys, start = (np.concatenate(x) for x in zip(*sets))
            sets.clear()
            rank = np.lexsort((start, tkeys, ids))
            ha, hb, ids, tkeys, start, source = (x[rank] for x in (ha, hb, ids, tkeys, start, source))
            order, first = _grouped(ha, hb)
            least = np.repeat(order[first], np.diff(np.append(first, len(order))))
            equal = (ids[order] == ids[least]) & (tkeys[order] == tkeys[least]) & (start[order] == start[least])
            cut = np.sort(order[~equal])
            cut = cut[np.argsort(source[cut], kind="stable")]
            edge = np.searchsorted(source[cut], np.arange(len(sources) + 1))
            rows = []
            for i in np.flatnonzero(np.diff(edge)).tolist():
                at = cut[edge[i]:edge[i + 1]]
                rows.append((sources[i], _pack_cuts(ids[at], tkeys[at], start[at], start[at] + window)))
            if rows:
                yield _rows(_REPLY, list(zip(*rows)))

    return later


# ---- cut ---------------------------------------------------------------------------------------

def _kept(body: bytes, cuts: list[tuple[int, int]]) -> tuple[str, int, int, str | None]:
    words = body.split()
    gone = np.zeros(len(words), dtype=bool)
    for lo, hi in cuts:
        gone[lo:hi] = True
    removed = int(gone.sum())
    rest = None
    if removed:
        words = [words[i] for i in np.flatnonzero(~gone)]
        rest = _without(body, gone).decode()
    return b" ".join(words).decode(), len(gone), removed, rest


def _without(body: bytes, gone: np.ndarray) -> bytes:
    """The text without its ``gone`` words and the white space behind each run of them."""
    starts, ends = text.spans(np.frombuffer(body, np.uint8), text.WHITE_SPACE)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    parts, at = [], 0
    for lo, hi in edge.reshape(-1, 2).tolist():
        parts.append(body[at:starts[lo]])
        at = starts[hi] if hi < len(starts) else ends[-1]
    return b"".join([*parts, body[at:]])


def _cutter(place: int | None):
    """``place``: where the text stands in the row; None if it is a column of its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in groupby(_runs(batches, "batch"), key=lambda x: x[0]):
            replies, cuts = [], None
            for _, part in run:
                more, part = _split(part)
                replies += more
                if not part.num_rows:
                    continue
                if cuts is None:
                    cuts = np.concatenate([np.empty((4, 0), np.int64), *[_unpack_cuts(r) for r in replies]], axis=1)
                    cuts = cuts[:, np.lexsort((cuts[1], cuts[0]))]
                ids, tkeys = part.column("id").to_numpy(), part.column("tkey").to_numpy()
                lo, hi = np.searchsorted(cuts[0], ids), np.searchsorted(cuts[0], ids, "right")
                out = []
                for i, body in enumerate(text.utf8(part.column("text") if place is None else part.column("row").field(place))):
                    mine = cuts[:, lo[i]:hi[i]]
                    mine = mine[:, mine[1] == tkeys[i]]
                    out.append(_kept(body, mine[2:].T.tolist()))
                kept, words, removed, rest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(rest, pa.string())],
                    ["row", "kept", "n_words", "n_removed", "rest"])

    return cut
