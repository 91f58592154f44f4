"""Words of whole texts in pieces of bounded size, and crc32 of many spans at once.

A long text is cut at separators into pieces of about ``text.SLICE_BYTES``;
each piece also holds the next words, as many as a run of words may reach
over its end, so that every run is met exactly once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from clinlake.llm import text

# The separators of `text.NON_WORD` behind case folding, as they stand in a text.
_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Spans longer than this are handed to zlib one by one.
LONG_SPAN = 64


class Words(NamedTuple):
    """Words of some texts: bytes with A-Z folded, spans, the text each word is
    of, where that text's words end here, and whether a run may begin here."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    until: np.ndarray
    begins: np.ndarray


def words(texts: list[bytes], ahead: int = 0) -> Iterator[Words]:
    """The folded words of all texts; runs of up to ``ahead + 1`` words are whole in one piece."""
    for lo, hi in text.slices(texts):
        if hi - lo == 1 and len(texts[lo]) > text.SLICE_BYTES:
            for body, own in _cut(texts[lo], ahead):
                buf, s, e, first = text.word_spans([body], text.NON_WORD, fold=True)
                yield Words(buf, s, e, np.full(len(s), lo), np.full(len(s), len(s)), s < own)
            continue
        buf, s, e, first = text.word_spans(texts[lo:hi], text.NON_WORD, fold=True)
        size = np.diff(first)
        yield Words(buf, s, e, np.repeat(np.arange(lo, hi), size), np.repeat(first[1:], size), np.ones(len(s), bool))


def _cut(body: bytes, ahead: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of a text with the words ahead, and the bytes that are the piece's own."""
    at = 0
    while at < len(body):
        cut = _SEPARATOR.search(body, min(len(body), at + text.SLICE_BYTES))
        end = reach = cut.start() if cut else len(body)
        for _ in range(ahead):
            found = _WORD.search(body, reach)
            if not found:
                break
            reach = found.end()
        yield body[at:reach], end - at
        at = end


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1).astype(np.uint32)
    return x


_TABLE = _crc_table()


def crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The unsigned crc32 of each span, going on from ``before`` (crc32 of what stands before it) if given."""
    out = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    size = ends - starts
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(out[i]))
    short = np.flatnonzero(size <= LONG_SPAN)
    # The longest first, so that those with a byte at a place stand in front.
    order = short[np.argsort(-size[short].astype(np.int8), kind="stable")]
    at, left = starts[order], size[order]
    state = ~out[order]
    upto = np.searchsorted(-left, -np.arange(LONG_SPAN + 1), "left")
    for j in range(int(left[0]) if len(left) else 0):
        n = int(upto[j])
        head = state[:n]
        state[:n] = _TABLE[(head ^ buf[at[:n] + j]) & np.uint32(255)] ^ (head >> np.uint32(8))
    out[order] = ~state
    return out


def run_crc32(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every run of ``length`` consecutive words of one text joined by
    one space, and the text that it is of."""
    at = np.flatnonzero(w.begins & (np.arange(len(w.starts)) + length <= w.until))
    crc = crc32(w.buf, w.starts[at], w.ends[at])
    space = np.full(1, 0x20, np.uint8)
    for k in range(1, length):
        crc = crc32(space, np.zeros(len(at), np.int64), np.ones(len(at), np.int64), crc)
        crc = crc32(w.buf, w.starts[at + k], w.ends[at + k], crc)
    return crc, w.owner[at]
