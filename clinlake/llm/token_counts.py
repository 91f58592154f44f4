"""Token counts, with overlapping chunks for huge documents.

Documents up to ``chunk`` bytes are encoded whole.  A longer one is encoded
in chunks that overlap; the token offsets of two neighbours are compared in
the overlap, and the text is spliced at the last position where both have a
token boundary and where a boundary is proven whatever the context (a space
behind a visible character).  Where the overlap holds no such position it is
doubled, in the end up to the rest of the text, so the count is always that
of the whole text, while memory is bounded by the chunk unless a single
unbroken run is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import bpe, segments, text

CHUNK = 64 << 10
OVERLAP = 2 << 10


def _char_start(body: bytes, at: int) -> int:
    """The last character boundary at or before ``at``."""
    while 0 < at < len(body) and body[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _boundaries(encode, sizes: np.ndarray, part: bytes) -> np.ndarray:
    """Byte offsets at which tokens of ``part`` begin, and its length."""
    ids = np.concatenate([np.empty(0, np.uint32), *[x[2] for x in encode([part])]])
    return np.append(0, np.cumsum(sizes[ids]))


def spliced_count(body: bytes, encode, sizes: np.ndarray, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one long text, by chunks."""
    at, count = 0, 0
    left = None
    while True:
        end = _char_start(body, min(len(body), at + chunk))
        if left is None:
            left = _boundaries(encode, sizes, body[at:end])
        width = overlap
        while end < len(body):
            lo = _char_start(body, max(at + 1, end - width))
            hi = _char_start(body, min(len(body), lo + chunk + width))
            right = _boundaries(encode, sizes, body[lo:hi])
            proven = np.flatnonzero(segments.before_space(np.frombuffer(body[lo:end], np.uint8))) + lo
            common = np.intersect1d(np.intersect1d(left + at, right + lo), proven)
            if len(common):
                break
            width *= 2
            if lo <= at + 1:  # the whole chunk overlaps and still holds no splice: make it longer
                end = _char_start(body, min(len(body), end + chunk))
                left = _boundaries(encode, sizes, body[at:end])
        if end >= len(body):
            return count + len(left) - 1
        splice = int(common[-1])
        count += int(np.searchsorted(left, splice - at))
        # The right chunk goes on as the left one of the next splice.
        left, at = right[right >= splice - lo] - (splice - lo), splice
        if at + left[-1] < len(body):
            left = _boundaries(encode, sizes, body[at:_char_start(body, min(len(body), at + chunk))])


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row: ``row`` (all columns of ``docs``), ``n_bytes`` and ``n_tokens``.

    ``tokenizer`` is a tokenizers file that every machine has.  No begin, end
    or other special token is added; the strings of special tokens inside a
    text count as the library treats them.  Null counts as empty: 0 bytes, 0
    tokens.  Rows are independent, so ids, ties and repeats do not matter.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sizes = bpe.encoder(tokenizer), bpe.token_bytes(tokenizer)
        for b in text.pieces(batches):
            texts = text.utf8(b.column("text"))
            tokens = np.zeros(len(texts), dtype=np.int64)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            for lo, hi, _, begin, _ in encode([texts[i] for i in short]):
                tokens[short[lo:hi]] = np.diff(begin)
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    tokens[i] = spliced_count(t, encode, sizes, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens)], ["row", "n_bytes", "n_tokens"])

    return rows.mapInArrow(count, schema)
