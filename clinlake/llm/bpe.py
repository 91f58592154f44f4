"""The byte-level tokenizer file behind a segment cache, once per worker."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from clinlake.llm.segments import STOPS, SegmentEncoder, byte_level


def separable(spec: dict) -> bool:
    """Whether the segment rule holds: byte-level splitting by the usual
    pattern, nothing before it, and no added token that a split could cut."""
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and all(not set(STOPS) & set(t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in spec["added_tokens"]))


@lru_cache(maxsize=2)
def encoder(path: str) -> SegmentEncoder:
    """The encoder of a tokenizer file; files that the segment rule does not fit are refused."""
    with open(path, encoding="utf-8") as f:
        if not separable(json.load(f)):
            raise ValueError(f"{path}: segments of this tokenizer are not independent")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return SegmentEncoder(lambda strings: [e.ids for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)],
                          byte_level, token_bytes(path))


@lru_cache(maxsize=2)
def token_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id stands for."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    size = np.zeros(max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]]) + 1, dtype=np.int64)
    # A byte-level token is written with one character per byte.
    for piece, i in spec["model"]["vocab"].items():
        size[i] = len(piece)
    for t in spec["added_tokens"]:
        size[t["id"]] = len(t["content"].encode())
    return size
