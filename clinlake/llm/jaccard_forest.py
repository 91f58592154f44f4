"""N-gram Jaccard join over a MinHash LSH forest, verified exactly.

Documents are sets of ``n``-word shingles.  The join links every two
documents of Jaccard similarity ``threshold`` or more.

1. Rows of equal text form a copy class; only one row of a class, its
   representative, takes part in what follows.
2. A signature is ``trees`` sequences of MinHash values.  Each sequence is a
   path in one prefix trie of the forest; a trie is held as its sorted
   prefixes, one hash per node, so a node is found by equality.  Matched
   prefixes start at ``max_depth`` values and are shortened until two
   documents right at the threshold still share a node of some trie with
   probability ``recall`` (`join_depth`).
3. Nodes with one member are dropped, and nodes of equal membership are kept
   once (they are told by count and sums of member hashes, which combine
   before the shuffle; no node is ever collected).
4. A node of many members or words is cut into blocks, and each pair of
   blocks is one group of bounded size.  A group computes its intersections
   as a matrix product over shared shingles and counts the links of each
   member; no pair leaves it.  A pair that shares nodes in several tries
   counts in the first.
5. Linked representatives are joined to classes by min-label propagation
   with pointer jumping, each round stored in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import stages, text

U64 = np.uint64
BLOCK_DOCS = 768
BLOCK_SHINGLES = 1 << 19

_SIGNED = "doc_id long, key binary, n_shingles long, bands array<long>"
_LINKS = "key binary, links long, root binary"


def join_depth(threshold: float, trees: int, max_depth: int, recall: float) -> int:
    """The longest prefix (at most ``max_depth`` values, at least one) with
    which the forest finds a pair at the threshold with probability ``recall``."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts (with repeats) and where each text's begin.

    A shingle is ``n`` consecutive words; a text of fewer words, but not none,
    is one shingle.  Words are cut at ASCII characters other than letters and
    digits, A-Z lower-cased.
    """
    buf, s, e, first = text.word_spans(texts, text.NON_WORD, fold=True)
    words = text.span_hash(buf, s, e)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    grams = text.rolling(words, n, 6)
    whole = owner[:len(grams)] == owner[n - 1:] if len(grams) else np.empty(0, bool)
    grams, owner = grams[whole], owner[:len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        lone = np.array([text.rolling(words[first[i]:first[i + 1]], int(counts[i]), 6)[0] for i in short], dtype=U64)
        order = np.argsort(np.append(owner, short), kind="stable")
        grams, owner = np.append(grams, lone)[order], np.append(owner, short)[order]
    return grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def _signer(n: int, trees: int, depth: int):
    rng = np.random.default_rng(11)
    factors = rng.integers(0, 2**31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    masks = rng.integers(0, 2**32, trees * depth, dtype=np.uint32)

    def bands(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        grams, begin = shingles(texts, n)
        out = np.zeros((len(texts), trees), dtype=U64)
        used = np.flatnonzero(np.diff(begin))
        if len(used):
            low = (grams >> U64(16)).astype(np.uint32)
            at = begin[used]
            for t in range(trees):
                path = np.full(len(used), t + 1, dtype=U64)
                for k in range(t * depth, (t + 1) * depth):
                    least = np.minimum.reduceat((low ^ masks[k]) * factors[k], at)
                    path = text.mix(path * U64(0x9E3779B97F4A7C15) + least)
                out[used, t] = path
        return out, np.diff(begin)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text.pieces(batches):
            texts = text.utf8(b.column("text"))
            for lo, hi in text.slices(texts, text.PIECE):
                nodes, count = bands(texts[lo:hi])
                nodes = nodes.view(np.int64)
                offsets = np.arange(0, (hi - lo + 1) * trees, trees, dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes.reshape(-1)),
                                                  mask=pa.array(count == 0))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), b.column("key").slice(lo, hi - lo), pa.array(count), column],
                    ["doc_id", "key", "n_shingles", "bands"])

    return sign


def _setter(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct shingle hashes of each text, sorted."""
        for b in text.pieces(batches):
            texts = text.utf8(b.column("text"))
            for lo, hi in text.slices(texts):
                grams, begin = shingles(texts[lo:hi], n)
                out = [np.unique(grams[begin[i]:begin[i + 1]]).tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(lo, hi - lo) for c in ("key", "bands", "copies", "nodes")] + [pa.array(out, pa.binary())],
                    ["key", "bands", "copies", "nodes", "grams"])

    return sets


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by a product of
    0/1 matrices over the shingles that both lists hold."""
    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    a, rows_a = flat(left)
    b, rows_b = flat(right)
    values, count = np.unique(np.append(np.unique(a), np.unique(b)), return_counts=True)
    values = values[count == 2]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(values):
        return out

    def places(x, rows):
        at = np.searchsorted(values, x)
        hit = values[np.minimum(at, len(values) - 1)] == x
        return at[hit], rows[hit]

    (ca, ra), (cb, rb) = places(a, rows_a), places(b, rows_b)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, ra, cb, rb = ca[oa], ra[oa], cb[ob], rb[ob]
    step = 4096
    for lo in range(0, len(values), step):
        i, j = np.searchsorted(ca, (lo, lo + step))
        k, m = np.searchsorted(cb, (lo, lo + step))
        width = min(step, len(values) - lo)
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        x[ra[i:j], ca[i:j] - lo] = 1
        y[rb[k:m], cb[k:m] - lo] = 1
        out += x @ y.T
    return out


def _linker(threshold: float):
    # Sizes are whole numbers, so the test needs no rounding: inter * (1 + t) >= t * (a + b).
    def links(left, right, same: bool, tree: int):
        sets_l, sets_r = [m[1] for m in left], [m[1] for m in right]
        if len(left) == 2 and same:
            a, b = sets_l
            inter = np.zeros((2, 2))
            inter[0, 1] = inter[1, 0] = len(np.intersect1d(a, b, assume_unique=True))
        else:
            inter = _intersections(sets_l, sets_r).astype(np.float64)
        size_l, size_r = np.array([len(s) for s in sets_l]), np.array([len(s) for s in sets_r])
        linked = inter * (1 + threshold) >= threshold * (size_l[:, None] + size_r[None, :]) - 1e-9
        if same:
            np.fill_diagonal(linked, False)
        i, j = np.nonzero(linked)
        if tree and len(i):
            bands_l, bands_r = np.stack([m[2] for m in left])[:, :tree], np.stack([m[2] for m in right])[:, :tree]
            fresh = np.zeros(len(i), dtype=bool)
            for lo in range(0, len(i), 1 << 16):
                a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
                fresh[lo:lo + (1 << 16)] = ~(bands_l[a] == bands_r[b]).any(axis=1)
            i, j = i[fresh], j[fresh]
        return i, j

    def group(members: list[tuple], first: int, second: int, tree: int):
        """Members are (key, set, bands, copies, block)."""
        left = [m for m in members if m[4] == first]
        right = left if first == second else [m for m in members if m[4] == second]
        if not left or not right:
            return
        i, j = links(left, right, first == second, tree)
        if not len(i):
            return
        every = left if first == second else left + right
        shift = 0 if first == second else len(left)
        copies = np.array([m[3] for m in every], dtype=np.int64)
        count = np.zeros(len(every), dtype=np.int64)
        np.add.at(count, i, copies[j + shift])
        if shift:
            np.add.at(count, j + shift, copies[i])
        root = _roots(len(every), i, j + shift)
        for k in np.flatnonzero(count).tolist():
            yield every[k][0], int(count[k]), every[root[k]][0]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in text.pieces(batches, 256) for r in zip(*[b.column(c).to_pylist() for c in
                                                  ("node", "first", "second", "tree", "key", "grams", "bands", "copies", "block")]))
        out = []
        for (_, first, second, tree), members in groupby(rows, key=lambda r: r[:4]):
            out += group([(r[4], np.frombuffer(r[5], U64), np.array(r[6]), r[7], r[8]) for r in members], first, second, tree)
            if len(out) > 20000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.binary()))], ["key", "links", "root"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.binary()))], ["key", "links", "root"])

    return verify


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that each index reaches over the links."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if np.array_equal(before, root):
            return root


def _components(edges: DataFrame) -> DataFrame:
    """``(key, label)``: the least key that each key reaches over ``edges`` (key, root).

    Rounds of hash-to-min: every key takes the least label next to it, and its
    label's label.  The number of rounds grows with the logarithm of a
    component's diameter.
    """
    both = edges.select(F.col("key").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
    both = stages.store(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "link-edges")
    labels = stages.store(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("key"), F.least("a", "b").alias("label")), "link-labels")
    while True:
        near = (both.join(labels.select(F.col("key").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near")))
        step = labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("next"))
        after = step.join(jump, "label", "left").select("key", "old", F.coalesce(F.least("label", "next"), "label").alias("label"))
        after = stages.store(after, "link-labels")
        if not after.where("label <> old").limit(1).count():
            return after.select("key", "label")
        labels = after.select("key", "label")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                 trees: int = 28, max_depth: int = 8, recall: float = 0.99999) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key`` (md5 of the text),
    ``n_shingles`` (with repeats), ``copies`` (rows of equal text, this one
    included), ``copy_of`` (their least id), ``n_links`` (other rows at or
    above the threshold, copies included), ``class_id`` (least id of all
    rows that links reach) and ``leads``: whether the row is the first of its
    class, by id (null last) and then by ``text_key``.

    With the defaults a pair exactly at the threshold is found with
    probability 0.9999996, a closer one with more; links that are found are
    exact.

    A null or empty text, or one without words, has no shingles: it is in
    a class of its own copies by text and links to nothing (its copies are
    not counted as links, since empty sets have no similarity).  Null counts
    as an empty text.  Null ids sort last, so ``copy_of`` and ``class_id`` are
    null only where all ids are.  Ties need no rule: links are symmetric.
    Repeated rows are copies of each other.  Other columns are not read.
    """
    depth = join_depth(threshold, trees, max_depth, recall)
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(body)).alias("key"), body.alias("text"))
    signed = stages.store(rows.mapInArrow(_signer(n, trees, depth), _SIGNED), "forest-signatures")

    reps = signed.groupBy("key").agg(F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("copies"),
                                     F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    reps = stages.store(reps, "forest-classes")
    paths = reps.where("bands is not null").select("key", "n_shingles", F.posexplode("bands").alias("tree", "node"))
    nodes = (paths.groupBy("node", "tree")
             .agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("words"),
                  F.min(F.xxhash64("key")).alias("least"), F.bit_xor(F.xxhash64("key")).alias("s1"),
                  F.bit_xor(F.xxhash64("key", F.lit(1))).alias("s2"))
             .where("members > 1"))
    # Equal membership: the first tree's node stands for all.
    nodes = (nodes.groupBy("members", "words", "least", "s1", "s2").agg(F.min(F.struct("tree", "node")).alias("n"))
             .select("n.tree", "n.node",
                     F.greatest(F.ceil(F.col("members") / BLOCK_DOCS), F.ceil(F.col("words") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    members = (paths.select("key", "tree", "node").join(nodes, ["tree", "node"])
               .groupBy("key").agg(F.collect_list(F.struct("node", "tree", "blocks")).alias("nodes")))
    wanted = (members.join(reps.select("key", "copy_of", "copies", "bands"), "key")
              .withColumnsRenamed({"key": "rep_key", "copy_of": "rep_id"}))
    texts = (rows.join(wanted, (F.col("key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
             .dropDuplicates(["rep_key", "rep_id"]).select("key", "text", "bands", "copies", "nodes"))
    sets = texts.mapInArrow(_setter(n), "key binary, bands array<long>, copies long, "
                                        "nodes array<struct<node:long,tree:int,blocks:int>>, grams binary")
    placed = sets.select("key", "bands", "copies", "grams", F.explode("nodes").alias("n")).select(
        "key", "bands", "copies", "grams", "n.*")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int"))
    # Each block meets itself and every other block once.
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "node", "tree", "key", "grams", "bands", "copies", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    spark = docs.sparkSession
    groups = (placed.repartition(stages.tasks(spark) * 2, "node", "first", "second")
              .sortWithinPartitions("node", "first", "second", "tree"))
    found = stages.store(groups.mapInArrow(_linker(threshold), _LINKS), "forest-links")

    labels = _components(found)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    ids = labels.join(reps.select("key", "copy_of"), "key")
    least = ids.groupBy("label").agg(F.min(F.struct(F.col("copy_of").isNull().alias("none"), "copy_of", "key")).alias("l"))
    classes = labels.join(least, "label").select("key", F.col("l.copy_of").alias("least"), F.col("l.key").alias("first"))
    known = (reps.join(links, "key", "left").join(classes, "key", "left")
             .select("key", "copy_of", "copies",
                     (F.coalesce("links", F.lit(0)) + F.when(F.col("n_shingles") > 0, F.col("copies") - 1).otherwise(0)).alias("n_links"),
                     F.coalesce("least", "copy_of").alias("class_id"), F.coalesce("first", "key").alias("first")))
    return signed.select("doc_id", "key", "n_shingles").join(known, "key").select(
        "doc_id", F.lower(F.hex("key")).alias("text_key"), "n_shingles", "copies", "copy_of", "n_links", "class_id",
        ((F.col("key") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("copy_of"))).alias("leads"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (null last),
    of equal ids that of the least md5.  Of rows equal in id and text one
    stays.  Texts without words keep a row for each id and text."""
    found = jaccard_join(docs, id_col, text_col, **options).where("n_shingles > 0")
    drop = found.where("not leads").select("doc_id", "text_key").distinct()
    drop = drop.withColumnsRenamed({"doc_id": "__drop_id", "text_key": "__drop_key"})
    body = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    kept = docs.join(drop, docs[f"`{id_col}`"].eqNullSafe(F.col("__drop_id")) & (F.md5(body) == F.col("__drop_key")), "left_anti")
    return kept.dropDuplicates([id_col, text_col])
