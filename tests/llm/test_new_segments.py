"""Ids of segments that an encoder meets for the first time."""

import numpy as np
from tokenizers import Tokenizer

from clinlake.llm import bpe
from clinlake.llm.queries import BYTE_BPE


def test_new_segments_are_encoded_without_a_list_each():
    """Ids of many new segments come as one array, the same as the library's for the whole text."""
    whole, encoder = Tokenizer.from_file(BYTE_BPE), bpe.encoder.__wrapped__(BYTE_BPE)
    texts = [" ".join(f"né{i * 31} b{i}," for i in range(300)), "", " a  b it's\n", "x"]
    ids = [flat[begin[i]:begin[i + 1]].tolist() for lo, hi, flat, begin, _ in encoder([t.encode() for t in texts]) for i in range(hi - lo)]
    assert ids == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    buf = np.frombuffer(b" ab cd x ", np.uint8)
    flat, begin, size, good = encoder._ids(buf, np.array([0, 3, 7]), np.array([3, 6, 8]))
    assert [flat[b:b + n].tolist() for b, n in zip(begin, size)] == [whole.encode(t, add_special_tokens=False).ids for t in (" ab", " cd", "x")] and good.all()
