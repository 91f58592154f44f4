"""Whole-text encoding through a cache of provably separate segments.

A tokenizer that splits its input before merging never lets a token span such
a split.  Texts are cut at places where a split is certain whatever stands
around (`before_space`, `byte_level`), each distinct segment is encoded once by
the tokenizer library, and the ids of a text are its segments' ids in order:
the same ids as for the whole text, with the library's work paid per distinct
segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np

from clinlake.llm import text

SLICE_BYTES = 1 << 20
CAPACITY = 500_000
#: Segments that the library encodes in one call; its results are much larger than the ids kept of them.
CALL = 4096
_JOIN = 64

U64 = np.uint64

_LETTER = text.byte_table((0x41, 0x5A), (0x61, 0x7A))
_GRAPHIC = text.byte_table((0x21, 0x7E))
# White space and the punctuation that no token joins to a letter before it.
STOPS = " \n,.!?;:"
_STOP = np.isin(np.arange(256), list(STOPS.encode()))
_TAIL = text.byte_table((0x80, 0xBF))
_LEAD = text.byte_table((0xC3, 0xDF))


def before_space(buf: np.ndarray) -> np.ndarray:
    """Marks spaces right behind a visible character.

    Visible are ASCII 0x21-0x7E and the two-byte characters from U+00C0 on,
    none of which is white space in Unicode.  Spaces behind longer characters
    (some of those are white space) are not marked; the segment is longer then.
    """
    mark = np.zeros(len(buf), bool)
    if len(buf) > 2:
        behind = _GRAPHIC[buf[1:-1]] | (_TAIL[buf[1:-1]] & _LEAD[buf[:-2]])
        mark[2:] = (buf[2:] == 0x20) & behind
    return mark


def byte_level(buf: np.ndarray) -> np.ndarray:
    """Marks splits of the byte-level pattern (``'s`` and the like, one space
    at most with letters, digits or others, runs of white space):

    * a space behind a visible character;
    * one of `STOPS` behind an ASCII letter: only letters go on with letters;
    * an ASCII letter behind a single line feed behind a visible ASCII
      character: a line feed never goes with letters, and a run of one white
      space character is one token in any place.
    """
    mark = before_space(buf)
    if len(buf) > 2:
        letter = _LETTER[buf]
        mark[1:] |= _STOP[buf[1:]] & letter[:-1]
        mark[2:] |= letter[2:] & (buf[1:-1] == 0x0A) & _GRAPHIC[buf[:-2]]
    return mark


class SegmentEncoder:
    """Ids of texts by segment, with the distinct segments' ids in a hash table
    of bounded size (it starts anew when full).

    ``encode`` maps a list of strings to a list of id lists.  ``marks`` is the
    split rule.  ``sizes``, if given, are the bytes that each id stands for:
    segments that begin with a space are then encoded many at a time as one
    string and told apart by their bytes.  ``check``, if given, tells for each
    string and its ids whether they stand up to a second opinion.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], marks: Callable[[np.ndarray], np.ndarray],
                 sizes: np.ndarray | None = None,
                 check: Callable[[list[str], list[list[int]]], list[bool]] | None = None, capacity: int = CAPACITY):
        self._encode, self.marks, self._sizes, self._check, self._capacity = encode, marks, sizes, check, capacity
        self._clear()

    def _clear(self) -> None:
        self._room(self._capacity)
        self._key = np.empty(0, U64)
        self._at = np.empty(0, np.int64)
        self._size = np.empty(0, np.int64)
        self._good = np.empty(0, bool)
        self._flat = np.empty(0, np.uint32)

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For consecutive texts ``lo`` to ``hi``: all their ids, where each
        text's ids begin (one more entry than texts), and whether each stood the check."""
        for lo, hi in text.slices(texts, SLICE_BYTES):
            yield lo, hi, *self._slice(texts[lo:hi])

    def _slice(self, texts: list[bytes]):
        buf, begins = text.joined(texts)
        mark = self.marks(buf)
        mark[begins[:-1]] = True
        mark[begins[1:] - 1] = False  # the joining space; an empty text has nothing else
        starts = np.flatnonzero(mark)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64), np.ones(len(texts), bool)
        edge = np.searchsorted(starts, begins)
        ends = np.append(starts[1:], 0)
        filled = np.flatnonzero(np.diff(edge))
        ends[edge[filled + 1] - 1] = begins[filled + 1] - 1
        place = self._places(text.span_hash(buf, starts, ends, 8), buf, starts, ends)
        size = self._size[place]
        upto = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=upto[1:])
        ids = self._flat[np.repeat(self._at[place] - upto[:-1], size) + np.arange(upto[-1])]
        bad = np.append(0, np.cumsum(~self._good[place]))
        return ids, upto[edge], bad[edge[1:]] == bad[edge[:-1]]

    def _room(self, entries: int) -> None:
        """An empty slot table with at least two slots an entry."""
        self._bits = int(np.ceil(np.log2(max(2, entries)))) + 1
        self._slots = np.full(1 << self._bits, -1, np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        left, slot = np.arange(len(keys)), (keys >> U64(64 - self._bits)).astype(np.int64)
        while len(left):
            entry = self._slots[slot]
            if len(self._key):
                hit = (entry >= 0) & (self._key[entry] == keys[left])
                out[left[hit]] = entry[hit]
                go = (entry >= 0) & ~hit
            else:
                go = np.zeros(len(left), bool)
            left, slot = left[go], (slot[go] + 1) & ((1 << self._bits) - 1)
        return out

    def _insert(self, keys: np.ndarray) -> None:
        """New keys become entries.  One slice may bring more than the capacity
        (a long text of many distinct segments): the slots then double."""
        entry = np.arange(len(self._key), len(self._key) + len(keys), dtype=np.int32)
        self._key = np.append(self._key, keys)
        if 2 * len(self._key) > len(self._slots):
            self._room(2 * len(self._key))
            entry, keys = np.arange(len(self._key), dtype=np.int32), self._key
        slot = (keys >> U64(64 - self._bits)).astype(np.int64)
        while len(entry):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = entry[free]
            lost = self._slots[slot] != entry
            entry, slot = entry[lost], (slot[lost] + 1) & ((1 << self._bits) - 1)

    def _places(self, keys, buf, starts, ends) -> np.ndarray:
        """The entry of each segment; segments that are missing come in."""
        if len(self._key) > self._capacity:
            self._clear()
        place = self._find(keys)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            distinct, first = np.unique(keys[missing], return_index=True)
            flat, begin, size, good = self._ids(buf, starts[missing[first]], ends[missing[first]])
            self._at = np.append(self._at, len(self._flat) + begin)
            self._size = np.append(self._size, size)
            self._good = np.append(self._good, good)
            self._flat = np.append(self._flat, flat)
            self._insert(distinct)
            place[missing] = self._find(keys[missing])
        return place

    def _ids(self, buf, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of segments, where each one's begin among them, how many they are, and whether they stood the check."""
        begin, size, good = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64), np.ones(len(starts), bool)
        # Behind a letter or stop, the space in front of the next one is a split.
        joint = np.zeros(len(starts), bool) if self._sizes is None or self._check else (
            (ends - starts > 1) & (buf[starts] == 0x20) & _GRAPHIC[buf[ends - 1]] & (buf[starts + 1] != 0x20))
        some = np.flatnonzero(joint)
        edge = np.append(0, np.cumsum((ends - starts)[some]))
        whole = buf[np.repeat(starts[some] - edge[:-1], np.diff(edge)) + np.arange(edge[-1])].tobytes()
        groups = np.append(edge[:-1:_JOIN], edge[-1]).tolist()
        strings = [whole[lo:hi].decode() for lo, hi in zip(groups[:-1], groups[1:])]
        step = CALL // _JOIN
        flat = np.concatenate([np.empty(0, np.uint32), *[_flat(self._encode(strings[i:i + step])) for i in range(0, len(strings), step)]])
        if len(some):
            upto = np.append(0, np.cumsum(self._sizes[flat]))
            cut = np.searchsorted(upto, edge)
            if upto[-1] != edge[-1] or (upto[cut] != edge).any():
                raise RuntimeError("a token spans a split: the split rule does not fit the tokenizer")
            begin[some], size[some] = cut[:-1], np.diff(cut)
        alone, found = np.flatnonzero(~joint), [flat]
        for i in range(0, len(alone), CALL):
            part = alone[i:i + CALL]
            bodies = [buf[lo:hi].tobytes().decode() for lo, hi in zip(starts[part].tolist(), ends[part].tolist())]
            ids = self._encode(bodies)
            size[part] = [len(x) for x in ids]
            if self._check:
                good[part] = self._check(bodies, ids)
            found.append(_flat(ids))
        begin[alone] = len(flat) + np.cumsum(size[alone]) - size[alone]
        return np.concatenate(found), begin, size, good


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
