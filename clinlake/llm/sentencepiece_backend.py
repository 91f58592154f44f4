"""SentencePiece models on the tokenizers library, with parity checked.

The model file is a protobuf; `parse_model` reads the fields it needs from
the wire format.  `build` makes the tokenizers pipeline from them: the
normaliser (precompiled character map, white-space squeezing, the dummy
prefix), the metaspace marker in place of spaces, the unigram scores or the
merges that the scores imply, byte fallback, and the decoder that undoes it.

Batches go to the library's multithreaded encoder.  Where the model allows it
(no character map, no squeezing, and no piece with the marker behind another
character) texts are cut in front of spaces and each distinct segment is
encoded once; the sentencepiece library encodes the same segments, and a text
whose ids differ anywhere is flagged.  Models that do not allow it are
encoded, and compared, whole text by whole text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from clinlake.llm import text
from clinlake.llm.segments import SegmentEncoder, before_space

MARK = "▁"
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message: varints as int, the rest as bytes."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            at += 1
            if data[at - 1] < 0x80:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = varint(at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    """What the tokenizer needs of a model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def separable(self) -> bool:
        """Whether no piece can span the place in front of a space behind a visible character."""
        return (self.kind == BPE and not self.charsmap and not self.squeeze and self.escape and self.byte_fallback
                and all(MARK not in p.lstrip(MARK) and k != USER_DEFINED for p, _, k in self.pieces))


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            model.pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
        elif number == 2:
            got = dict(_fields(value))
            model.kind, model.byte_fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
        elif number == 3:
            got = dict(_fields(value))
            model.charsmap = got.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(got.get(i, 1)) for i in (3, 4, 5))
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """The merges that make each normal piece, best piece first."""
    known = {p: i for i, (p, _, k) in enumerate(model.pieces) if k in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in known.items():
        found += [(-model.pieces[i][1], i, k, piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in known and piece[k:] in known]
    return [(a, b) for *_, a, b in sorted(found)]


def build(model: Model, prefix: bool = True) -> Tokenizer:
    """The tokenizers pipeline of a model; ``prefix=False`` leaves out the dummy prefix."""
    unknown = model.pieces[model.unknown][0]
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges(model), unk_token=unknown,
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("neither a unigram nor a BPE model")
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if model.dummy_prefix and prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    tokenizer = Tokenizer(core)
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    tail = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix and prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return tokenizer


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.model = parse_model(data)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        parts = [bytes([int(p[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode()
                 for p, _, k in self.model.pieces]
        self._size = np.array([len(p) for p in parts], dtype=np.int64)
        self._at = np.cumsum(self._size) - self._size
        self._bytes = np.frombuffer(b"".join(parts), np.uint8)
        self._segments = None
        if self.model.separable:
            bare = build(self.model, prefix=False)
            self._segments = SegmentEncoder(
                lambda strings: [e.ids for e in bare.encode_batch_fast(strings, add_special_tokens=False)], before_space,
                check=lambda strings, ids: self._agree(bare, strings, ids))

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The whole-text pipeline."""
        return build(self.model)

    def _agree(self, bare: Tokenizer, strings: list[str], ids: list[list[int]]) -> list[bool]:
        """Whether sentencepiece has the same ids, and the library decodes them to the string."""
        prefix = self.model.dummy_prefix
        # The library adds the dummy prefix itself: a segment's own first space stands for it.
        bodies = [s[1:] if prefix and s[:1] == " " and len(s) > 1 else s for s in strings]
        same = [s == b or not prefix for s, b in zip(bodies, strings)]
        theirs = self.library.encode(bodies, num_threads=1)
        plain = bare.decode_batch(ids, skip_special_tokens=False)
        return [(x == y or (alone and prefix)) and d == s.replace(MARK, " ") for x, y, s, d, alone in zip(theirs, ids, strings, plain, same)]

    def encode(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For consecutive texts: ``lo, hi, ids, begins, parity`` (see `SegmentEncoder`)."""
        if self._segments is not None:
            framed = [b" " + t if t and self.model.dummy_prefix else t for t in texts]
            yield from self._segments(framed)
            return
        for lo, hi in text.slices(texts):
            strings = [t.decode() for t in texts[lo:hi]]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
            theirs = self.library.encode(strings, num_threads=1)
            yield (lo, hi, np.array([i for x in ids for i in x], np.uint32), np.append(0, np.cumsum([len(x) for x in ids])),
                   np.array([a == b for a, b in zip(ids, theirs)], dtype=bool))

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The texts of consecutive id runs: pieces in order, markers as spaces,
        byte pieces as bytes, without the dummy prefix."""
        size = self._size[ids]
        upto = np.append(0, np.cumsum(size))
        out = self._bytes[np.repeat(self._at[ids] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        edge = upto[begins]
        skip = 1 if self.model.dummy_prefix else 0
        return [out[lo + skip:hi] if hi > lo else b"" for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist())]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (all columns of ``docs``), ``ids`` (array of int),
    ``decoded`` (the text of the ids), ``round_trip`` (it equals the text) and
    ``parity`` (sentencepiece gives the same ids).

    ``model`` is a file that every machine has.  Null counts as the empty
    text, whose ids are none.  Special tokens are not added, and their names
    inside a text are ordinary text.  Rows are independent of each other.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
                           T.StructField("round_trip", T.BooleanType()), T.StructField("parity", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in text.pieces(batches):
            texts = text.utf8(b.column("text"))
            for lo, hi, ids, begins, parity in c.encode(texts):
                back = c.decode(ids, begins)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids.astype(np.int32))),
                     pa.array([x.decode(errors="replace") for x in back], pa.string()),
                     pa.array([x == t for x, t in zip(back, texts[lo:hi])]), pa.array(parity)],
                    ["row", "ids", "decoded", "round_trip", "parity"])

    return rows.mapInArrow(run, schema)
