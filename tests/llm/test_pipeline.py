"""The pipeline's stages take effect, and the whole agrees with brute force."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from clinlake.llm import langid
import __spark_entry__ as E

import llm_brute as brute

SMALL = "/root/testdata/sf0.001"


def test_registered(spark):
    names = set(E.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "benchmark_decontamination", "sentencepiece"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    spoken = steps["language_id"](spark, docs, SMALL)
    assert spoken.columns == docs.columns
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 0), order=F.xxhash64("doc_id"))
    kept = [i for i, r in rows.items() if any(c.isalpha() for c in r.text or "") and model.scores([r.text.encode()]).max() >= model.threshold]
    assert sorted(r.doc_id for r in spoken.collect()) == sorted(kept)
    assert len(kept) >= 0.98 * len(rows)

    single = steps["near_duplicates"](spark, spoken, SMALL)
    classes = brute.links([(i, rows[i].text) for i in kept])
    kept = [i for i in kept if classes[i][1] == i]
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(kept)

    cut = steps["substring_dedup"](spark, single, SMALL)
    want = brute.repeats(sorted((i, rows[i].text) for i in kept))
    got = {r.doc_id: (r.text, r.n_chars, r.lang, r.source) for r in cut.collect()}
    assert cut.columns == docs.columns
    assert {i: (" ".join(brute.TOKEN.findall(g[0])), *g[2:]) for i, g in got.items()} == {i: (want[i][0], rows[i].lang, rows[i].source) for i in kept}
    whole = [i for i in kept if not want[i][2]]
    assert whole and any("\n" in rows[i].text for i in whole)
    assert all(got[i][:2] == (rows[i].text, rows[i].n_chars) for i in whole)  # untouched, line breaks and all
    assert all(g[1] == len(g[0]) for i, g in got.items() if want[i][2])

    clean = steps["benchmark_decontamination"](spark, cut, SMALL)
    pool = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hits = brute.contamination([(i, t[0]) for i, t in got.items()], pool)
    kept = [i for i in kept if not hits[i, got[i][0]][1]]
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(kept)

    final = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in final) == sorted(kept)
    assert all(r.decoded == got[r.doc_id][0] and r.n_tokens == len(r.ids) and r.parity for r in final)


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_pass_every_stage(spark, stage):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "the only text", None, "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SMALL)
    # One text is too few to know a language, so the first stage rejects all.
    assert out.count() == {"language_id": 0, "near_duplicates": 3}.get(stage, 4)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs.where("n_chars = -1"), SMALL).count() == 0
