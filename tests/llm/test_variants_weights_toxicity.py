"""Spelling variants, importance resampling and toxicity: brute force, odd rows, held-out accuracy."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import importance, queries, runs, spelling, toxicity

import llm_brute as brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"längerword{i % 4001} Ünïversal{'x' * (i % 5)}" for i in range(120000))
ODD = [(1, "Variantly variantly VARIANTLY variantli variantly, variantly variantly variantly variantly variantly variantly"), (2, None), (3, ""),
       (4, "éÀ÷× 12"), (None, "variantly variantli naïveté naïvete naïvete"), (5, "variantly"), (5, "variantly"), (6, LONG), (7, "!!! ???"),
       (8, "a" * 5000 + " " + "a" * 5000 + " " + "a" * 4999)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 2 else None, 7, "k", 3, "r", "tk", ["a"]) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {brute.EXTRA}")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# ---- word runs

@pytest.mark.parametrize("length", [1, 2, 3])
def test_run_crcs_of_whole_texts(length):
    texts = ["The cat, x2 SAT Ünï", "", "one", "a" * 200 + " b " + "c" * 70, LONG]
    got = [[] for _ in texts]
    for w in runs.words([t.encode() for t in texts], length - 1):
        crc, owner = runs.run_crc32(w, length)
        for i in range(len(texts)):
            got[i] += crc[owner == i].tolist()
    for t, found in zip(texts, got):
        words = brute.words(t)
        assert found == [zlib.crc32(" ".join(words[i:i + length]).encode()) for i in range(len(words) - length + 1)]


# ---- spelling variants

def test_variants_equal_brute_force(spark, docs, odd):
    for table in (docs, odd):
        want = brute.variants([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])
        for symbols in (None, 2, 9):
            got = spelling.variants(table, symbols=symbols)
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_variants_of_an_empty_table(odd):
    assert spelling.variants(odd.where("doc_id = -1")).collect() == []


def test_roots_follow_long_chains(spark):
    steps = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "b")], "word string, root string")
    assert {r.word: r.root for r in spelling.follow(steps).collect()} == {**{f"w{i}": "w11" for i in range(11)}, "a": "b"}


def test_neighbourhoods_hold_every_reduced_word_one_edit_away():
    for word in ["0012", "00000", "0102010", "2"]:
        near = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "012"}
        near |= {word[:i] + word[i + 1:] for i in range(len(word))}
        near |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in "012"} - {word}
        key = lambda w: int(spelling.neighbourhood(np.array([[int(c) for c in w]], np.int64).reshape(1, -1), 3)[0][0])
        _, _, got = spelling.neighbourhood(np.array([[int(c) for c in word]]), 3)
        assert sorted(got.tolist()) == sorted(key(w) for w in near)


def test_crowded_reduced_words_are_not_compared_pair_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abcdé"), size)) for size in rng.integers(7, 10, 4000)})
    table = spark.createDataFrame([(w, 2 + i % 50) for i, w in enumerate(words)], "word string, n long")
    want = brute.near(words)
    want = {(a, b) for a in want for b in want[a] if a < b}
    compared = []
    plain = spelling.one_edit
    monkeypatch.setattr(spelling, "one_edit", lambda a, b: compared.append(len(a)) or plain(a, b))
    for crowded in (1 << 16, 0):
        monkeypatch.setattr(spelling, "CROWDED", crowded)
        compared.clear()
        sender, found = spelling._sender(2, 3), set()
        sent = [b for b in sender(iter(table.toArrow().combine_chunks().to_batches()))]
        import pyarrow as pa
        dealt = pa.Table.from_batches(sent).sort_by("bucket").combine_chunks().to_batches()
        for b in spelling._verify(iter(dealt)):
            found |= {tuple(sorted(p)) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())}
        assert found == want
    # Only what shares a key was looked at: near pairs from both sides, and each word with itself at every place.
    assert sum(compared) <= 4 * len(want) + sum(map(len, words))


# ---- importance resampling

def _resampled(rows, items, per_hundred=10):
    def buckets(t):
        return [zlib.crc32(w.encode()) % 10000 for w in brute.words(t)]

    s, t = (collections.Counter(b for x in texts for b in buckets(x)) for texts in ([x for _, x in rows], items))
    sa, ta = sum(s.values()), sum(t.values())
    out = []
    for i, x in rows:
        found = buckets(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (sa + 10000) / ((s[b] + 1) * (ta + 10000)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((o for o in out if o[1] >= 20), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    drawn = able[:per_hundred * len(able) // 100]
    return out, drawn


@pytest.mark.parametrize("few", [4096, 2])
def test_resampling_equals_brute_force(spark, docs, odd, few):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    for table, share in ((docs, 10), (docs, 37), (odd, 60), (odd, 100)):
        rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
        want, drawn = _resampled(rows, [r.text for r in items.collect()], share)
        got = importance.resample(table, items, per_hundred=share, few=few).collect()
        assert sorted(map(repr, want)) == sorted(repr((r.id, r.n_features, r.weight, r.score)) for r in got)
        ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
        assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
        assert [(r.score, r.id) for r in ranked] == [(d[3], d[0]) for d in drawn]


def test_resampling_of_empty_tables(spark, docs, odd):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    none = odd.where("doc_id = -1")
    assert importance.resample(none, items).collect() == []
    blank = importance.resample(docs, items.limit(0)).collect()
    assert len(blank) == docs.count() and max(r["rank"] or 0 for r in blank) > 0


@pytest.mark.parametrize("k", [1, 2, 499, 500, 777, 1000])
def test_selection_finds_the_exact_key(spark, tmp_path, k):
    rng = np.random.default_rng(k)
    keys = [(int(a), int(b), 0) for a, b in zip(rng.integers(-5, 5, 1000), rng.integers(0, 40, 1000))]  # many equal keys
    spark.createDataFrame(keys, "neg long, id long, tie long").repartition(7).write.parquet(str(tmp_path / "keys"))
    table = spark.read.parquet(str(tmp_path / "keys"))
    assert importance.kth_key(table, k, few=1) == sorted(keys)[k - 1]
    assert importance.kth_key(table, 1001) is None and importance.kth_key(table, 0) is None


def test_a_weighted_median_leaves_a_quarter_on_either_side():
    rng = np.random.default_rng(0)
    for _ in range(50):
        parts = [sorted(rng.integers(0, 1000, rng.integers(1, 60)).tolist()) for _ in range(9)]
        pivot = importance.weighted_median([((p[(len(p) - 1) // 2],), len(p)) for p in parts])[0]
        every = [x for p in parts for x in p]
        assert 4 * sum(x <= pivot for x in every) >= len(every) and 4 * sum(x >= pivot for x in every) >= len(every) - 4 * len(parts)


def test_longer_runs_as_features(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = importance.bucket_counts(docs, length=2, buckets=100)
    want = collections.Counter()
    for _, t in rows:
        w = brute.words(t)
        want.update(zlib.crc32(" ".join(w[i:i + n]).encode()) % 100 for n in (1, 2) for i in range(len(w) - n + 1))
    assert {i: n for i, n in enumerate(got.tolist()) if n} == dict(want)


# ---- toxicity

def test_features_are_words_pairs_and_skips():
    def count(t):
        w = brute.words(t)
        return len({(x,) for x in w} | {(1, *x) for x in zip(w, w[1:])} | {(2, *x) for x in zip(w, w[2:])})

    texts = ["You ABSOLUTE fool, you absolute fool", "", "x", LONG]
    got = toxicity.coordinates([t.encode() for t in texts])
    assert [len(x) for x in got[:3]] == [count(t) for t in texts[:3]]
    assert 0.97 * count(LONG) <= len(got[3]) <= count(LONG)  # a million coordinates: few meet
    assert (got[3] == toxicity.coordinates([LONG.encode()])[0]).all()


def test_the_learner_follows_the_ftrl_rule():
    rng = np.random.default_rng(1)
    f = toxicity.Ftrl(np.zeros(toxicity.BUCKETS + 1), np.zeros(toxicity.BUCKETS + 1), alpha=0.5, beta=1.0, l1=0.3, l2=0.1)
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        l1 = 0.0 if i == toxicity.BUCKETS else 0.3
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.5 + 0.1)

    for _ in range(200):
        at = np.sort(rng.choice(30, rng.integers(0, 8), replace=False))
        y, heft = int(rng.random() < 0.4), float(rng.uniform(0.5, 2))
        f.learn(at, y, heft)
        used = [*at.tolist(), toxicity.BUCKETS]
        g = (1 / (1 + math.exp(-sum(weight(i) for i in used))) - y) * heft
        for i in used:
            w = weight(i)
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * w
            n[i] += g * g
    got = f.weights()
    assert all(abs(got[i] - weight(i)) < 1e-9 for i in [*range(30), toxicity.BUCKETS])
    assert not got[30:-1].any()


def test_toxicity_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    in_fold = toxicity.fold(F.col("doc_id")) != 0
    model = toxicity.fit(docs.where(in_fold), labels.where(in_fold))
    assert 0 < len(model.at) < 20_000
    held = docs.where(~in_fold).join(labels.select("doc_id", "toxic"), "doc_id")
    got = [(r.row.toxic, r.score) for r in toxicity.score(held, model).collect()]
    toxic, clean = ([s for y, s in got if y == k] for k in (1, 0))
    assert np.mean([s >= 0.5 for s in toxic]) >= 0.7 and np.mean([s < 0.5 for s in clean]) >= 0.99
    order = np.argsort(np.argsort([s for _, s in got])) + 1
    area = (sum(o for o, (y, _) in zip(order, got) if y) - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert area >= 0.97


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (2, 1, 0), (5, 0, 0), (6, 0, 1), (7, 0, None), (None, 1, 1), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, labels, passes=2, l1=0.0)
    got = toxicity.score(odd, model)
    assert got.schema["row"].dataType.names == odd.columns
    rows = got.collect()
    assert len(rows) == len(ODD) and all(0 < r.score < 1 for r in rows)
    blank = {r.score for r in rows if not brute.words(r.row.text)}
    assert len(blank) == 1 and abs(blank.pop() - 1 / (1 + math.exp(-model.bias))) < 1e-12
    assert len({r.score for r in rows if r.row.doc_id == 5}) == 1
    assert toxicity.fit(odd, labels, passes=2, l1=0.0).weight.tolist() == model.weight.tolist()  # the same in every run
    assert toxicity.score(odd.where("doc_id = -1"), model).collect() == []
    untaught = toxicity.fit(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, untaught).collect()} == {0.5}


def test_the_sample_is_bounded_for_either_label(spark, docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    twice = docs.unionByName(docs.where("doc_id = 8"))  # an id that comes more than once is used once
    found = toxicity.sample(twice, labels, 60, "doc_id", "text", "toxic").collect()
    by = collections.Counter(r.label for r in found)
    assert by == {0: 30, 1: 30}
    share = {r.label: r.share for r in found}
    n = collections.Counter(r.toxic for r in labels.collect())
    assert abs(share[0] / share[1] - n[0] / n[1]) < 1e-9
    assert len(toxicity.sample(twice, labels, 10_000, "doc_id", "text", "toxic").collect()) == docs.where("text is not null").count()


def test_registered_queries(spark):
    got = queries.op13_toxicity(spark, MIDDLE)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
