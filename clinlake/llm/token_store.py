"""Token-id files: one zstandard frame per document under a shared dictionary.

Documents are dealt to ranges of ascending id, encoded, and written as
blocks.  A block is a self-describing byte string:

    magic "TIDBLK01" | sha256 of the dictionary (32 bytes) | id width (u32) | documents n (u32)
    | n document ids (i64) | n null flags (u8) | n token counts (u64) | n+1 frame offsets (u64) | frames

so one short document is read with two index entries and one frame
(`read_document`).  Ids are little-endian unsigned numbers of ``width`` bytes
(2 while the vocabulary allows it).  Blocks, their sums and the dictionary
are tables below one folder, committed by Spark's own writer; a lost executor
costs a task, not a file.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinlake.llm import bpe, stages, text
from clinlake.session import derived_path

MAGIC = b"TIDBLK01"
BLOCK_DOCS = 2048
BLOCK_TOKENS = 1 << 21
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 512
SAMPLE_CHARS = 4096

_BLOCKS = "part int, seq long, n_docs long, n_tokens long, block binary"
_DOCS = "part int, seq long, doc_id long, before long, n_tokens long, ids_crc32 long"


@lru_cache(maxsize=4)
def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of serialized id arrays; too few samples give
    their own bytes as the dictionary, and none gives none."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def write_block(ids: list[np.ndarray], doc_ids: list[int | None], dictionary: bytes, width: int) -> bytes:
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=True)
    frames = [compressor.compress(x.astype(f"<u{width}").tobytes()) for x in ids]
    offsets = np.zeros(len(ids) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    return b"".join([
        MAGIC, hashlib.sha256(dictionary).digest(), np.array([width, len(ids)], "<u4").tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "<u1").tobytes(),
        np.array([len(x) for x in ids], "<u8").tobytes(), offsets.tobytes(), *frames])


class Block:
    """The index of a block, and its documents on demand."""

    def __init__(self, data: bytes, dictionary: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id block")
        if data[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        self.width, n = (int(x) for x in np.frombuffer(data, "<u4", 2, 40))
        at = 48
        fields = []
        for kind, count in (("<i8", n), ("<u1", n), ("<u8", n), ("<u8", n + 1)):
            fields.append(np.frombuffer(data, kind, count, at))
            at += fields[-1].nbytes
        self.ids, nulls, self.counts, self._offsets = fields
        self.nulls = nulls.astype(bool)
        self._data, self._base = memoryview(data), at
        self._reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def read_document(self, i: int) -> np.ndarray:
        """The token ids of document ``i`` of the block."""
        lo, hi = self._base + int(self._offsets[i]), self._base + int(self._offsets[i + 1])
        raw = self._reader.decompress(self._data[lo:hi], max_output_size=int(self.counts[i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


@dataclass
class TokenFiles:
    """Where a set of token-id files lies."""

    folder: str
    spark: SparkSession

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(_BLOCKS).parquet(f"{self.folder}/blocks")

    def dictionary(self) -> bytes:
        return bytes(self.spark.read.parquet(f"{self.folder}/dictionary").first()["data"])  # bounded: DICTIONARY_BYTES

    def read(self) -> DataFrame:
        """Per document, from the files: ``doc_id``, ``start`` (tokens of all
        documents before it), ``n_tokens``, ``ids_crc32``."""
        dictionary = self.dictionary()

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part, seq, data in zip(*[b.column(c).to_pylist() for c in ("part", "seq", "block")]):
                    block = Block(data, dictionary)
                    n = len(block.ids)
                    crc = [zlib.crc32(block.read_document(i).astype("<u4").tobytes()) for i in range(n)]
                    counts = block.counts.astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int64()), pa.array(block.ids, mask=block.nulls),
                         pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(crc, pa.int64())],
                        ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"])

        docs = self.blocks().select("part", "seq", "block").mapInArrow(decode, _DOCS)
        return docs.join(self._starts(), ["part", "seq"]).select(
            "doc_id", (F.col("block_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

    def _starts(self) -> DataFrame:
        """Tokens before each block: totals per part (one row per written part)
        are summed over the parts, then block totals within a part."""
        sums = self.blocks().select("part", "seq", "n_tokens")
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(
            "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
        within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        return sums.join(parts, "part").select("part", "seq", (
            F.col("part_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("block_start"))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encode every text, append ``end_id``, and write the files in ascending id order.

    Null texts count as empty and give the end id alone; null ids come last;
    rows of equal id follow a hash of their text, and repeated rows are all
    written.  An empty table gives files without documents.  Other columns
    are not read.  The dictionary is trained on the first ``SAMPLE_CHARS``
    characters of ``SAMPLE_DOCS`` documents (least hashes of id and text);
    it changes file sizes only.
    """
    spark = docs.sparkSession
    folder = derived_path(spark, "token-ids")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tkey", F.xxhash64("text"))
    width = 2 if len(bpe.token_bytes(tokenizer)) <= 1 << 16 and end_id < 1 << 16 else 4

    # Hashes in a share of about 2 x SAMPLE_DOCS of all rows, so that few rows leave the tasks.
    h = F.xxhash64("id", "tkey")
    sample = (rows.where(F.pmod(h, F.lit(max(1, docs.count()))) < 2 * SAMPLE_DOCS)
              .select(h.alias("h"), F.substring("text", 1, SAMPLE_CHARS).alias("t"))
              .orderBy("h", "t").limit(SAMPLE_DOCS).collect())  # bounded: SAMPLE_DOCS x SAMPLE_CHARS
    ids = [x[2][x[3][i]:x[3][i + 1]] for x in bpe.encoder(tokenizer)([r["t"].encode() for r in sample]) for i in range(x[1] - x[0])]
    dictionary = train_dictionary([x.astype(f"<u{width}").tobytes() for x in ids])
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "sha256 string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        docs_in, ids_in, size = [], [], 0

        def flush():
            block = write_block(ids_in, docs_in, dictionary, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([len(docs_in)], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([block], pa.binary())], ["part", "seq", "n_docs", "n_tokens", "block"])

        for b in text.pieces(batches):
            names = b.column("id").to_pylist()
            for lo, hi, flat, begin, _ in encoder(text.utf8(b.column("text"))):
                for i in range(hi - lo):
                    mine = np.append(flat[begin[i]:begin[i + 1]], np.uint32(end_id))
                    if docs_in and (len(docs_in) == BLOCK_DOCS or size + len(mine) > BLOCK_TOKENS):
                        yield flush()
                        docs_in, ids_in, size, seq = [], [], 0, seq + 1
                    docs_in.append(names[lo + i])
                    ids_in.append(mine)
                    size += len(mine)
        if docs_in:
            yield flush()

    parts = max(stages.tasks(spark), min(8192, stages.text_bytes(docs, text_col) // (32 << 20)))
    order = [F.col("id").asc_nulls_last(), F.col("tkey")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    stages.write(dealt.mapInArrow(encode, _BLOCKS), f"{folder}/blocks")
    return TokenFiles(folder, spark)
