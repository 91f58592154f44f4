"""Benchmark decontamination with DataFrame functions only.

The windows of all benchmark items (``size`` consecutive words; an item of
fewer words is one window) are hashed and, while their table is at most
``max_broadcast_bytes``, broadcast; a larger table is joined by a shuffle on
the hash instead.

Scanning.  A full window of ten words holds a whole block of five that starts
at a multiple of five in the text, so the text sends one probe per block
against the hash set of all five-word runs of the windows.  Around each match
the (at most six) windows that hold the block are looked up, and a hit is
verified word by word.  Windows of fewer words are probed at every start.
The hits of a document are merged to the count of covered words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_BROADCAST_BYTES = 32 << 20
# Repeated rows made at once.
_COPIES = 1 << 16


def normal_words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, cut at ASCII characters other than
    letters and digits.  Null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is the same as the A-Z translation when all characters are ASCII, and faster.
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(folded, SEPARATORS), "")


def _run_hashes(words: Column, length: int, step: int) -> Column:
    """The hashes of the runs of ``length`` words at starts 0, step, 2 step, ..."""
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length, F.lit(step))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(length))))


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``(hash, length, gram, items)``: each distinct window and the ids (text, sorted) that hold it.

    Items without words have no window; items with a null id still protect
    their words but are not listed.
    """
    words = items.select(F.col(f"`{item_col}`").cast("string").alias("item"), normal_words(F.col(f"`{text_col}`")).alias("words"))
    words = words.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(size)))
    starts = words.select("item", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("i"))
    grams = starts.select("item", "length", F.slice("words", F.col("i") + 1, F.col("length")).alias("gram"))
    return (grams.groupBy(F.array_join("gram", " ").alias("joined"), "length")
            .agg(F.first("gram").alias("gram"), F.sort_array(F.collect_set("item")).alias("items"))
            .select(F.xxhash64("gram").alias("hash"), "length", "gram", "items"))


def covered(ranges: Column) -> Column:
    """Words covered by sorted ``(start, length)`` ranges, overlaps counted once."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def step(acc, r):
        end = r["start"] + r["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(r["start"], acc["upto"]))).alias("n"),
                        F.greatest(acc["upto"], end).alias("upto"))

    return F.aggregate(ranges, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES, each_row: bool = True) -> DataFrame:
    """Per row of ``docs``: ``id``, ``text_key``, ``n_words``, ``n_hit``, ``items``, ``ranges``.

    ``items`` are the benchmark ids (as text, sorted) with a window in the
    document, ``ranges`` the hit word ranges.  A null or empty text has no
    words and no hits; a null id is a value of its own.  Repeated rows give
    repeated results (one row per distinct id and text with
    ``each_row=False``).  An empty benchmark hits nothing, an empty ``docs``
    gives no rows.  Columns other than those named are not read.
    """
    windows = benchmark_windows(items, item_col, item_text_col, size)
    # One row: the lengths in use (at most ``size`` of them) and the table's size.
    found = windows.agg(F.collect_set("length").alias("lengths"),
                        F.sum(F.octet_length(F.array_join("gram", " ")) * 2 + 64 * F.col("length")
                              + 32 * F.size("items") + 64).alias("bytes")).first()
    small = (found["bytes"] or 0) <= max_broadcast_bytes
    block = (size + 1) // 2
    # (run length, step, words in a window): full windows by their blocks, shorter ones whole at every start.
    shapes = [(block, block, size)] + [(n, 1, n) for n in found["lengths"] if n < size]
    anchors = windows.select("length", F.explode(F.when(F.col("length") < size, F.array("hash")).otherwise(
        _run_hashes(F.col("gram"), block, 1))).alias("anchor")).distinct().withColumnRenamed("length", "anchor_length")

    text = F.col(f"`{text_col}`")
    words = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("text_key"),
                        normal_words(text).alias("words"))
    # Slot 0 of each array stands for the document itself, so that documents without a hit stay.
    probe = F.explode(F.array(*[
        F.struct(F.lit(window).alias("window"), F.lit(step).alias("step"),
                 F.concat(F.array(F.lit(None).cast("long")), _run_hashes(F.col("words"), run, step)).alias("hashes"))
        for run, step, window in shapes])).alias("probe")
    probes = words.select("id", "text_key", "words", probe).select(
        "id", "text_key", "words", "probe.window", "probe.step", F.posexplode_outer("probe.hashes").alias("slot", "hash"))
    matches = (F.col("hash") == F.col("anchor")) & (F.col("window") == F.col("anchor_length"))
    if small:
        near = probes.join(F.broadcast(anchors), matches, "left").where((F.col("slot") == 0) | F.col("anchor").isNotNull())
    else:
        # The words stay behind while the probes are shuffled, and are joined to the few that match.
        slim = probes.drop("words")
        near = (slim.where("slot > 0").join(anchors, matches, "left_semi").unionByName(slim.where("slot = 0"))
                .join(words.dropDuplicates(["id", "text_key"]).withColumnsRenamed({"id": "w_id", "text_key": "w_key"}),
                      F.col("id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key"))))
    at = (F.col("slot") - 1) * F.col("step")
    least = F.greatest(F.lit(0), F.when(F.col("step") > 1, at + block - size).otherwise(at))
    most = F.least(at, F.size("words") - F.col("window"))
    near = near.withColumn("start", F.explode_outer(F.when((F.col("slot") > 0) & (least <= most), F.sequence(least, most))))
    near = near.select("id", "text_key", "slot", F.size("words").alias("n_words"), "start", F.col("window").alias("length"),
                       F.when(F.col("start").isNotNull(), F.slice("words", F.col("start") + 1, F.col("window"))).alias("found"))
    near = near.withColumn("found_hash", F.when(F.col("start").isNotNull(), F.xxhash64("found")))
    known = windows.select("hash", "gram", "items", F.col("length").alias("gram_length"))
    hits = near.join(F.broadcast(known) if small else known,
                     (F.col("found_hash") == F.col("hash")) & (F.col("length") == F.col("gram_length")), "left")
    verified = F.col("found") == F.col("gram")
    rows = hits.select("id", "text_key", "n_words", (F.col("slot") == 0).alias("self"), F.when(verified, F.struct("start", "length")).alias("range"),
                       F.when(verified, F.col("items")).alias("items"))
    per_doc = rows.groupBy("id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        (F.count_if("self") / len(shapes)).cast("long").alias("copies"),  # slot 0 comes once per shape and row
        F.array_sort(F.collect_set("range")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    if each_row:
        # In two steps, so that no array is as long as a large group of copies.
        run = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_COPIES).cast("long"))
        per_doc = per_doc.withColumn("copy", F.explode(run)).withColumn(
            "copy", F.explode(F.sequence(F.col("copy"), F.least(F.col("copy") + _COPIES, F.col("copies")) - 1)))
    return per_doc.select("id", "text_key", "n_words", covered(F.col("ranges")).cast("long").alias("n_hit"), "items", "ranges")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; other rows and all columns stay as they are."""
    hit = contamination(docs, items, id_col, text_col, each_row=False, **options).where("n_hit > 0").select(
        F.col("id").alias("__hit_id"), F.col("text_key").alias("__hit_key"))
    key = F.xxhash64(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")))
    return docs.join(hit, docs[f"`{id_col}`"].eqNullSafe(F.col("__hit_id")) & (key == F.col("__hit_key")), "left_anti")
