"""New segments go to the tokenizer library in calls of bounded size."""

from clinlake.llm import segments, sentencepiece_backend
from clinlake.llm.queries import PIECES


def test_the_library_gets_a_bounded_number_of_new_segments_at_a_time():
    codec = sentencepiece_backend.codec.__wrapped__(PIECES)
    encoder, calls = codec._segments, []
    plain, check = encoder._encode, encoder._check
    encoder._encode = lambda strings: (calls.append(len(strings)), plain(strings))[1]
    encoder._check = lambda strings, ids: (calls.append(len(strings)), check(strings, ids))[1]
    texts = [" ".join(f"w{i * 7919 % 100003} é{i}" for i in range(6000)), "", "\n", "a  b"]
    got = [(ids[a:b].tolist(), bool(good)) for _, _, ids, begins, parity in codec.encode([t.encode() for t in texts])
           for a, b, good in zip(begins[:-1], begins[1:], parity)]
    assert got == [(codec.library.encode(t), True) for t in texts]
    assert sum(calls) > 20000 and max(calls) <= segments.CALL
