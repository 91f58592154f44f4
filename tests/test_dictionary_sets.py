"""Category dictionaries as tables, and bounded distinct sets per vector dimension."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clinlake.operators.dictionary import category_dictionary, encode
from clinlake.operators.features import index_categories, vector_cardinality
from clinlake.operators.vector_sets import BoundedSets, bounded_distinct, category_flags, category_maps
from clinlake.plans.standins import table
from clinlake.plans.stroke import CATEGORICAL, stroke_clean, stroke_source
from clinlake.operators.clean import age_bands

from conftest import SF01


def test_codes_equal_the_indexer_on_the_stroke_columns(spark):
    d = stroke_clean(stroke_source(spark, SF01)).withColumn("age", age_bands("age"))
    labels = [c + "_label" for c in CATEGORICAL]
    want = index_categories(d, CATEGORICAL).select("id", *labels)
    got = encode(d, CATEGORICAL, category_dictionary(d, CATEGORICAL)).select("id", *labels)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # few categories cost no shuffle


@pytest.mark.parametrize("hot, hot_bytes", [(1000, 1 << 20), (3, 1 << 20), (1000, 0)])
def test_many_categories_with_a_hot_one(spark, hot, hot_bytes):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("v"), F.floor(F.col("id") / 2))).alias("a b"), F.lit(1).alias("value"), F.lit("x").alias("code"))
    words = category_dictionary(df, ["a b"])
    rows = sorted((r.code, r.value, r.n) for r in words.collect())
    n = {}
    for r in df.collect():
        if r["a b"] is not None:
            n[r["a b"]] = n.get(r["a b"], 0) + 1
    want = [(i, v, c) for i, (c, v) in enumerate(sorted((-c, v) for v, c in n.items()))]
    assert rows == [(i, v, -c) for i, v, c in want]
    code = {v: i for i, v, _ in want}
    out = encode(df, ["a b"], words, invalid="null", hot=hot, hot_bytes=hot_bytes)
    assert out.columns == [*df.columns, "a b_label"]
    got = out.collect()
    assert len(got) == 3000 and all(r["a b_label"] == code.get(r["a b"]) for r in got)


def test_values_without_a_code(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    words = category_dictionary(df.where("c = 'a'"), ["c"])
    assert sorted((r.c or "", r.c_label) for r in encode(df, ["c"], words, invalid="null").collect()) == [("", None), ("a", 0), ("b", None)]
    for bad in (df, df.where("c = 'b'"), df.where("c is null")):
        with pytest.raises(Exception, match="no code for a value of c"):
            encode(bad, ["c"], words).collect()
    empty = category_dictionary(df.limit(0), ["c"])
    assert empty.collect() == [] and [r.c_label for r in encode(df, ["c"], empty, invalid="null").collect()] == [None] * 3
    with pytest.raises(ValueError):
        encode(df, ["c"], words, invalid="skip")


def test_sets_stop_growing():
    rng = np.random.default_rng(2)
    sets, seen = BoundedSets(5), {}
    for _ in range(20):
        dim, value = rng.integers(0, 6, 300), rng.integers(0, 40, 300) / 7
        value[dim == 0] = rng.choice([0.0, -0.0, np.nan, 1.5], (dim == 0).sum())
        value[dim == 1] = rng.integers(0, 5, (dim == 1).sum())
        sets.add(dim, value)
        for d, v in zip(dim.tolist(), value.tolist()):
            seen.setdefault(d, set()).add("nan" if math.isnan(v) else v + 0.0)
        assert len(sets.dim) <= 6 * 5
    assert sets.over.tolist() == [len(seen[d]) > 5 for d in range(6)]
    assert (np.bincount(sets.dim, minlength=6)[:2] == [3, 5]).all()


def test_flags_equal_the_exact_count(spark):
    rows = [([float(i % 3), float(i), None if i % 2 else 4.0, float("nan") if i % 4 else 0.0, None],) if i % 10 else (None,) for i in range(500)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(6)
    want = {r.dim: (r.n_values, r.is_categorical) for r in vector_cardinality(df, "x", 100).collect()}
    assert {r.dim: (r.n_values, r.is_categorical) for r in category_flags(df, "x", 100).collect()} == want
    assert want[4] == (0, True)  # a dimension of NULLs alone


def test_maps_equal_the_vector_indexer(spark):
    emb = table(spark, SF01, "embeddings").select(F.transform(F.col("embedding").cast("array<double>"), lambda v, i: F.when(
        i % 3 == 0, F.floor(v * 10).cast("double")).when(i % 3 == 1, F.round(v, 2)).otherwise(v)).alias("x"))
    model = VectorIndexer(inputCol="v", outputCol="o", maxCategories=100).fit(emb.select(array_to_vector("x").alias("v")))
    want = {(d, v, c) for d, m in model.categoryMaps.items() for v, c in m.items()}
    assert {(r.dim, r.value, r.code) for r in category_maps(emb, "x", 100).collect()} == want


def test_shuffled_rows_are_bounded_by_tasks_and_dimensions(spark):
    """A hundred times the rows: no more rows leave the tasks."""
    def leaving(n):
        df = spark.range(0, n, 1, 4).select(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double")).alias("x"))
        df = bounded_distinct(df, "x", 10)
        return df.agg(F.count(F.lit(1))).first()[0]

    assert leaving(1000) == leaving(100_000) == 2 + 7  # the overflown dimension leaves its flag alone
