"""Document operators against brute force, on the small tables and on odd rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinlake.llm import (bm25, bpe, decontaminate, jaccard_forest, langid, queries, segments, sentencepiece_backend, substring,
                          token_counts, token_store)

import llm_brute as brute

SMALL = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = " ".join(f"w{i}" for i in range(30))
LONG = " ".join(f"word{i % 977} Ünï{i % 31}" for i in range(60000))
ODD = [(1, PASSAGE), (2, "x " + PASSAGE + "\n\ty"), (2, "x " + PASSAGE + "\n\ty"), (3, None), (4, ""), (5, " \t\n"), (None, PASSAGE + " z"),
       (None, None), (6, "one"), (7, "one"), (8, LONG), (9, PASSAGE + " " + PASSAGE), (9, "other text of the same id"), (10, "!!! ???")]
WEIRD = ["a  b   c \n d", "  lead", "trail  ", "x y z　 w  ", "don't <|endoftext|> a<|endoftext|>b", " ", "\n\n a", "é à ù  ", "",
         "日本 語  x", "a.\nB.\n\nC", "🎉 🎉a 1 23 4,5 .. !!  x", "a  b", "x  y", "tab\t tab", "it's we'll I'M"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def pairs(docs):
    return sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 2 else None, 7, "k", 3, "r", "tk", ["a"]) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {brute.EXTRA}")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -1")


# ---- n-gram Jaccard join

def test_join_depth_shortens_until_the_recall_is_met():
    assert jaccard_forest.join_depth(0.8, 28, 8, 0.99999) == 4
    assert jaccard_forest.join_depth(0.8, 20, 8, 0.999) == 5
    assert jaccard_forest.join_depth(0.8, 20, 3, 0.999) == 3
    assert jaccard_forest.join_depth(0.1, 1, 8, 0.999) == 1


def test_links_and_classes(docs, pairs):
    want = brute.links(pairs)
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard_forest.jaccard_join(docs).collect()}
    assert got == want


def test_links_of_odd_rows(odd, none):
    rows = jaccard_forest.jaccard_join(odd).collect()
    by_id = {(r.doc_id, r.n_links, r.copies, r.class_id) for r in rows}
    assert len(rows) == len(ODD)
    assert (6, 1, 2, 6) in by_id and (7, 1, 2, 6) in by_id          # equal texts of one word
    assert {r.n_links for r in rows if r.doc_id in (3, 4, 5, 10)} == {0}  # no words, no links
    # The passage, its two longer copies (one row twice) and the one of a null id; 9 holds the passage twice.
    assert {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert jaccard_forest.jaccard_join(none).collect() == []


def test_keep_one(odd):
    kept = [(r.doc_id, r.text) for r in jaccard_forest.keep_one(odd).collect()]
    assert (1, PASSAGE) in kept and (7, "one") not in kept and (6, "one") in kept
    assert not [t for i, t in kept if i == 2]
    assert len(kept) == len(set(kept))


def test_keep_one_of_near_copies_of_one_id(spark):
    near = PASSAGE + " end"
    rows = [(2, PASSAGE), (2, near), (2, "quite another text of the same id"), (None, PASSAGE + " tail"), (None, "null words alone here"),
            (None, "null words alone here"), (None, "null words alone here too and more of them"), (5, "null words alone")]
    kept = sorted((r.doc_id or 0, r.text) for r in jaccard_forest.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    first = min((PASSAGE, near), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert kept == sorted([(2, first), (2, rows[2][1]), (0, rows[4][1]), (0, rows[6][1]), (5, "null words alone")])


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Blocks of a node meet each other once, and each link counts once."""
    monkeypatch.setattr(jaccard_forest, "BLOCK_DOCS", 7)
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(base[:5 + k % 40] + [f"new{k}"] + base[5 + k % 40:])) for k in range(60)] + [(100 + k, " ".join(base)) for k in range(30)]
    want = brute.links(rows)
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard_forest.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


# ---- decontamination

def test_many_repeated_rows_come_back(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "_COPIES", 7)
    docs = spark.range(50).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one").alias("text"))
    items = spark.createDataFrame([(5, "one")], "item_id long, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert len(got) == 50 and {(r.id, r.n_words, r.n_hit, *r["items"]) for r in got} == {(1, 1, 1, "5")}


ITEMS = [(1, "w3 w4 W5 w6 w7 w8 w9 w10 w11 w12 w13"), (2, None), (3, "..."), (None, "one"), (12, "other TEXT"), (11, "text of")]


@pytest.mark.parametrize("limit", [1 << 20, 0])  # broadcast, and the shuffle join beyond the bound
def test_contamination(spark, docs, pairs, odd, none, limit):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    pool = [(r.item_id, r.text) for r in items.collect()]
    want = {k: v for k, v in brute.contamination(pairs, pool).items()}
    got = decontaminate.contamination(docs, items, max_broadcast_bytes=limit).collect()
    assert {r.id: (r.n_words, r.n_hit, r["items"]) for r in got} == {i: v for (i, _), v in want.items()}
    own = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute.contamination([x for x in ODD], ITEMS)
    got = decontaminate.contamination(odd, own, max_broadcast_bytes=limit).collect()
    # One row per row: those that come twice are there twice, null and empty texts of one id as well.
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((key((r.id, r.n_words, r.n_hit, r["items"])) for r in got)) == sorted(key((i, *want[i, t])) for i, t in ODD)
    assert decontaminate.contamination(odd, own, max_broadcast_bytes=limit, each_row=False).count() == len({(i, t or "") for i, t in ODD})
    twice = own.sparkSession.createDataFrame([(1, None), (1, ""), (1, ""), (2, "one"), (2, "one")], "doc_id long, text string")
    assert decontaminate.contamination(twice, own, max_broadcast_bytes=limit).count() == 5
    clean = decontaminate.drop_contaminated(odd, own, max_broadcast_bytes=limit)
    assert clean.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, t in ODD if not want[i, t][1])
    assert decontaminate.contamination(odd, own.limit(0), max_broadcast_bytes=limit).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(none, own, max_broadcast_bytes=limit).collect() == []


def test_contamination_runs_no_python(spark, docs):
    plan = queries.op4_benchmark_decontamination(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


# ---- substring dedup

def test_repeats(docs, pairs):
    want = brute.repeats(pairs)
    got = {r.row.doc_id: (r.kept, r.n_words, r.n_removed) for r in substring.remove_repeats(docs).collect()}
    assert got == want


def test_repeats_of_odd_rows(odd, none):
    got = [(r.row.doc_id, r.row.text, r.kept, r.n_removed) for r in substring.remove_repeats(odd).collect()]
    assert len(got) == len(ODD)
    by = {(i, t): (k, n) for i, t, k, n in got}
    assert by[1, PASSAGE] == (PASSAGE, 0)
    assert by[2, "x " + PASSAGE + "\n\ty"] == ("x y", 30)           # equal rows share a place; both follow row 1
    assert by[None, PASSAGE + " z"] == ("z", 30)                     # a null id comes last
    assert by[9, PASSAGE + " " + PASSAGE][1] == 60
    assert by[3, None] == ("", 0) and by[5, " \t\n"] == ("", 0)
    long = brute.repeats([(0, LONG)])[0]
    assert by[8, LONG] == (long[0], long[2])
    assert substring.remove_repeats(none).collect() == []


def test_repeats_over_many_batches(docs, pairs, monkeypatch):
    monkeypatch.setattr(substring, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(substring, "BUCKET_KEYS", 1 << 12)
    want = brute.repeats(pairs)
    got = {r.row.doc_id: (r.kept, r.n_words, r.n_removed) for r in substring.remove_repeats(docs).collect()}
    assert got == want


# ---- tokens

def test_segments_are_the_whole_text():
    whole = Tokenizer.from_file(BYTE_BPE)
    encoder = bpe.encoder(BYTE_BPE)
    for lo, hi, ids, begin, _ in encoder([w.encode() for w in WEIRD]):
        for i in range(lo, hi):
            assert ids[begin[i - lo]:begin[i - lo + 1]].tolist() == whole.encode(WEIRD[i], add_special_tokens=False).ids


def test_segment_cache_starts_anew_when_full():
    whole = Tokenizer.from_file(BYTE_BPE)
    tiny = segments.SegmentEncoder(lambda s: [e.ids for e in whole.encode_batch_fast(s, add_special_tokens=False)], segments.byte_level,
                                   bpe.token_bytes(BYTE_BPE), capacity=4)
    for text in WEIRD * 2:
        (_, _, ids, _, _), = tiny([text.encode()])
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_segment_cache_holds_a_text_of_more_segments_than_its_capacity():
    whole = Tokenizer.from_file(BYTE_BPE)
    small = segments.SegmentEncoder(lambda s: [e.ids for e in whole.encode_batch_fast(s, add_special_tokens=False)], segments.byte_level,
                                    bpe.token_bytes(BYTE_BPE), capacity=1000)
    for text in [" ".join(f"q{i * 7919}" for i in range(20000)), "short one", " ".join(f"z{i}" for i in range(5000))]:
        (_, _, ids, _, _), = small([text.encode()])
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (500, 16), (5000, 100)])
def test_splices(chunk, overlap):
    whole = Tokenizer.from_file(BYTE_BPE)
    encode, sizes = bpe.encoder(BYTE_BPE), bpe.token_bytes(BYTE_BPE)
    for text in ["x" * 3000, "ab" * 900 + " " + "日本" * 500 + " fin", LONG[:20000], "a \n" * 800, " " * 2000 + "x", "<|endoftext|>" * 200, *WEIRD]:
        body = text.encode()
        if len(body) > chunk:
            assert token_counts.spliced_count(body, encode, sizes, chunk, overlap) == len(whole.encode(text, add_special_tokens=False).ids)


def test_token_counts(docs, odd, none):
    whole = Tokenizer.from_file(BYTE_BPE)
    for table in (docs, odd):
        for r in token_counts.count_tokens(table, BYTE_BPE, chunk=2000, overlap=64).collect():
            text = r.row.text or ""
            assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(whole.encode(text, add_special_tokens=False).ids))
    assert token_counts.count_tokens(none, BYTE_BPE).collect() == []


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, pairs, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 7)
    whole = Tokenizer.from_file(BYTE_BPE)
    files = token_store.write_tokens(docs, BYTE_BPE, 2)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in files.read().collect()}
    at = 0
    for i, text in pairs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (at, len(ids), _crc(ids))
        at += len(ids)
    # One short document from its block, by the index.
    dictionary = files.dictionary()
    row = files.blocks().orderBy("part", "seq").first()
    block = token_store.Block(bytes(row.block), dictionary)
    assert block.ids[3] == pairs[3][0]
    assert block.read_document(3).tolist() == whole.encode(pairs[3][1] or "", add_special_tokens=False).ids + [2]
    with pytest.raises(ValueError):
        token_store.Block(bytes(row.block), dictionary + b"x")


def test_token_files_of_odd_rows(odd, none):
    whole = Tokenizer.from_file(BYTE_BPE)
    rows = token_store.write_tokens(odd, BYTE_BPE, 2).read().collect()
    assert sorted(r.ids_crc32 for r in rows) == sorted(_crc(whole.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in ODD)
    assert sorted(r.start for r in rows)[0] == 0 and len({r.start for r in rows}) == len(ODD)
    assert max(r.start for r in rows if r.doc_id is not None) < min(r.start for r in rows if r.doc_id is None)
    assert token_store.write_tokens(none, BYTE_BPE, 2).read().collect() == []


# ---- sentencepiece

def test_pieces_are_sentencepieces(docs, odd, none):
    codec = sentencepiece_backend.codec(queries.PIECES)
    for table in (docs, odd):
        for r in sentencepiece_backend.encode_decode(table, queries.PIECES).collect():
            text = r.row.text or ""
            assert list(r.ids) == codec.library.encode(text)
            assert (r.decoded, r.round_trip, r.parity) == (text, True, True)
    assert sentencepiece_backend.encode_decode(none, queries.PIECES).collect() == []


def test_whole_text_pipeline_and_marker_in_text():
    codec = sentencepiece_backend.codec(queries.PIECES)
    texts = [*WEIRD, "a▁b ▁ c", "   ", "<s> </s> <0x0A>"]
    assert [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)] == codec.library.encode(texts)
    for lo, hi, ids, begin, _ in codec.encode([t.encode() for t in texts]):
        assert [ids[begin[i]:begin[i + 1]].tolist() for i in range(hi - lo)] == codec.library.encode(texts)
        assert [x.decode() for x in codec.decode(ids, begin)] == [t.replace("▁", " ") for t in texts]


def test_unigram_model_is_rebuilt(tmp_path):
    """A hand-written unigram model file: scores, character coverage by bytes, dummy prefix."""
    def piece(text, score, kind=1):
        import struct
        body = b"\x0a" + bytes([len(text.encode())]) + text.encode() + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind])
        return b"\x0a" + bytes([len(body)]) + body

    pieces = [piece("<unk>", 0, 2), piece("<s>", 0, 3), piece("</s>", 0, 3)] + [piece(f"<0x{i:02X}>", -20, 6) for i in range(256)]
    pieces += [piece(p, s) for p, s in (("▁", -3), ("▁a", -1), ("b", -2), ("ab", -2.5), ("▁ab", -1.5), ("a", -4))]
    trainer, normaliser = b"\x18\x01\x98\x02\x01", b"\x18\x01\x20\x00\x28\x01"
    path = tmp_path / "unigram.model"
    path.write_bytes(b"".join(pieces) + b"\x12" + bytes([len(trainer)]) + trainer + b"\x1a" + bytes([len(normaliser)]) + normaliser)
    codec = sentencepiece_backend.Codec(str(path))
    texts = ["ab a b", "abab", "é a", ""]
    (lo, hi, ids, begin, parity), = codec.encode([t.encode() for t in texts])
    assert [ids[begin[i]:begin[i + 1]].tolist() for i in range(hi - lo)] == codec.library.encode(texts)
    assert parity.all() and [x.decode() for x in codec.decode(ids, begin)] == texts


# ---- search

def test_top_k(spark, docs, pairs):
    asked = [i for i, _ in pairs if i % 20 == 0]
    want = brute.bm25(pairs, asked)
    got = {i: [] for i in asked}
    for r in bm25.search(docs, docs.where(bm25.every_nth(F.col("doc_id")))).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    for q in asked:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert all(abs(a[1] - b[1]) < 2e-6 for a, b in zip(got[q], want[q]))


def test_blocks_below_the_threshold_are_skipped():
    """Short documents of a rare word, among many long ones: their block alone is looked into, and the answer is exact."""
    rare = [b"needle " + b" ".join(f"w{i * 3 + j}".encode() for j in range(3)) for i in range(30)]
    common = [b" ".join([b"needle", *[f"c{(i * 7 + j) % 900}".encode() for j in range(300)]]) for i in range(3000)]
    texts, ids = rare + common, np.arange(3030)
    _, found, _, length = bm25.term_counts(texts)
    terms, df = np.unique(found, return_counts=True)
    index = bm25.Index(terms, df, len(texts), length.mean(), 1.2, 0.75)
    for lo in range(0, len(texts), 500):
        index.add(ids[lo:lo + 500], texts[lo:lo + 500])
    index.seal()
    _, asked, _, _ = bm25.term_counts([b"needle"])
    top, scores, seen = index.search(asked, 10)
    assert top.tolist() == list(range(10)) and len(set(scores.tolist())) == 1  # ties go to the smaller ids
    assert seen == bm25.FIRST_BLOCKS and index.n_blocks == 48
    assert index.search(np.array([1, 2], np.uint64), 10)[0].tolist() == []


def test_top_k_over_shards_is_the_same(docs, monkeypatch):
    queries_ = docs.where(bm25.every_nth(F.col("doc_id"), 50))
    one = sorted(bm25.search(docs, queries_, k=3).collect())
    monkeypatch.setattr(bm25, "SHARD_BYTES", 60_000)
    assert sorted(bm25.search(docs, queries_, k=3).collect()) == one


def test_top_k_of_odd_rows(odd, none):
    rows = bm25.search(odd, odd.where("doc_id is not null"), k=4).collect()
    assert not [r for r in rows if r.query_id in (3, 4, 5, 10)]
    assert [(r["rank"], r.doc_id) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 6] == [(1, 6), (2, 7)]
    assert None in {r.doc_id for r in rows if r.query_id == 1}
    assert bm25.search(none, odd).collect() == [] and bm25.search(odd, none).collect() == []


# ---- language

def test_language_accuracy_and_folds(spark):
    got = queries.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(odd, none):
    model = langid.train([b"the and of that", b"der und die das", b"with this for", b"ein nicht mit"] * 20, ["en", "de", "en", "de"] * 20)
    got = [(r.row.doc_id, r.lang_pred, r.score, r.rejected) for r in langid.identify(odd, model).collect()]
    assert len(got) == len(ODD)
    assert {x[1:] for x in got if x[0] in (3, 4, 5, 10)} == {("und", 0.0, True)}
    assert all(x[1] in ("en", "de") for x in got if x[0] in (1, 6, 7, 8))
    assert langid.identify(none, model).collect() == []
    empty = langid.fit(none)
    assert {r.rejected for r in langid.identify(odd, empty).collect()} == {True}


def test_whole_texts_are_scored():
    model = langid.train([b"the and of that", b"der und die das"] * 40, ["en", "de"] * 40)
    long = b"der und die das " * 40_000
    assert model.scores([long, b"the and of"]).argmax(axis=1).tolist() == [0, 1]
    assert np.allclose(model.scores([long])[0], model.scores([b"der und die das " * 1000])[0], atol=1e-3)


def test_training_reads_whole_texts_and_every_subword():
    at, share = langid.bag(b"noise " * 3000 + b"der und die", 1 << 15)
    head, _ = langid.bag(b"noise " * 3000, 1 << 15)
    assert set(at.tolist()) > set(head.tolist()) and abs(share.sum() - 1) < 1e-5
    long = (LONG * 2).encode()
    assert len(long) > 2 * langid.text.PIECE
    whole = np.zeros(1 << 15)
    for found, inside in langid.subwords(np.frombuffer(long + b" ", np.uint8), 1 << 15):
        whole += np.bincount(found[inside], minlength=1 << 15)
    at, share = langid.bag(long, 1 << 15)
    dense = np.zeros(1 << 15)
    dense[at] = share
    assert np.abs(dense - whole / whole.sum()).max() < 1e-4  # pieces are cut at spaces; only runs over a cut differ


def test_a_rare_language_is_learned(spark):
    rng = np.random.default_rng(5)

    def prose(words, n):
        return " ".join(rng.choice(words.split(), n))

    rows = [(i, prose("the and of that with this for from", 60), "en") for i in range(3000)]
    rows += [(5000 + i, prose("der und die das ein nicht mit von", 60), "de") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, limit=200)
    assert model.languages == ["de", "en"]
    assert model.scores([b"und das ist nicht von mir", b"this is from that"]).argmax(axis=1).tolist() == [0, 1]
    assert np.array_equal(model.table, langid.fit(docs, limit=200).table)  # the same in every run
    found = langid.sample(docs, "text", "lang", F.xxhash64("doc_id"), 200, 1 << 15).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in found} == {"en": 100, "de": 10}


def test_texts_of_no_known_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 0), order=F.xxhash64("doc_id"))
    junk = ["xqzj kvwp zzqx wvkq jjxq", "Привет мир это простой текст", "日本語のテキストです"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(junk)], "doc_id long, text string")
    assert [r.rejected for r in langid.identify(table, model).collect()] == [True] * 3
    held = docs.where(langid.fold(F.col("doc_id")) == 0).where("lang is not null and n_chars > 200")
    assert langid.identify(held, model).where("rejected").count() <= 0.005 * held.count()
    # Half of one language and half of another: one of both, and kept.
    both = {l: held.where(F.col("lang") == l).where("n_chars between 1500 and 4000").orderBy("doc_id").limit(15).collect() for l in ("en", "fr")}
    mixed = [(i, a.text[:900] + " " + b.text[:700]) for i, (a, b) in enumerate(zip(both["en"], both["fr"]))]
    kept = langid.identify(spark.createDataFrame(mixed, "doc_id long, text string"), model).where("not rejected").count()
    assert kept >= 13
