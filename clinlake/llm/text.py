"""Word spans and rolling hashes over whole texts, vectorised with numpy.

Texts are handled as UTF-8 bytes.  Hashes are polynomial sums modulo 2**64
over per-byte random values, finished with a bit mixer; they are the same on
every executor and in every run (fixed seeds).  Work goes through pieces of
``PIECE`` bytes, so the temporary arrays stay small however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 18
SLICE_BYTES = 1 << 20

U64 = np.uint64


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A boolean table over byte values, true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


# Separators of the two word rules in use.
WHITE_SPACE = byte_table((0x20, 0x20), (0x09, 0x0D))
NON_WORD = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
# A-Z to a-z, every other byte unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


@lru_cache(maxsize=8)
def _tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per-byte values, powers of an odd base, and powers of its inverse."""
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
    base = int(rng.integers(2**61, 2**62)) * 4 + 3
    powers = np.full(PIECE + 1, base, dtype=U64)
    inverse = np.full(PIECE + 1, pow(base, -1, 2**64), dtype=U64)
    powers[0] = inverse[0] = 1
    return values, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective bit mixer on 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about ``limit`` bytes together."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by a space, and where each begins."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return buf, begins


def spans(buf: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-separator bytes."""
    outside = np.ones(len(buf) + 2, dtype=np.int8)
    outside[1:-1] = separator[buf]
    edge = np.diff(outside)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend and do not overlap."""
    out = np.empty(len(starts), dtype=U64)
    values, powers, inverse = _tables(seed)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + PIECE, "right"))
        if j <= i:  # one span longer than a piece
            digest = hashlib.blake2b(buf[base:int(ends[i])].tobytes(), digest_size=8, salt=seed.to_bytes(4, "little"))
            out[i] = int.from_bytes(digest.digest(), "little")
            i += 1
            continue
        piece = buf[base:int(ends[j - 1])]
        run = np.zeros(len(piece) + 1, dtype=U64)
        np.cumsum(values[piece] * powers[:len(piece)], out=run[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((run[e] - run[s]) * inverse[s] + (e - s).astype(U64))
        i = j
    return out


def rolling(words: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """A hash of each run of ``size`` consecutive word hashes (one per start)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    _, powers, inverse = _tables(seed)
    out = np.empty(n, dtype=U64)
    step = PIECE - size
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        part = words[lo:hi + size - 1]
        run = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * powers[:len(part)], out=run[1:])
        out[lo:hi] = mix((run[size:] - run[:-size]) * inverse[:hi - lo])
    return out


def word_spans(texts: list[bytes], separator: np.ndarray, fold: bool = False):
    """``(buf, starts, ends, first)``: the word spans of all texts, and the
    index of each text's first word (one more entry than texts)."""
    buf, begins = joined(texts)
    if fold:
        buf = FOLD[buf]
    starts, ends = spans(buf, separator)
    return buf, starts, ends, np.searchsorted(starts, begins)


def pieces(batches: Iterator, rows: int = 2048) -> Iterator:
    """Arrow batches in slices of at most ``rows`` rows (no copies), so that what
    is made of a slice stays small beside the batch."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def utf8(column) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null counts as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
