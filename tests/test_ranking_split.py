import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clinlake.operators.ranking import running_total
from clinlake.operators.split import hash_split, shuffle_rows, split_label, union_slices


def test_running_total_matches_cumsum(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 800), "v": rng.integers(0, 50, 800), "id": np.arange(800),
                        "w": rng.integers(1, 5, 800)})
    df = spark.createDataFrame(pdf.astype("int64"))
    for n in (1, 4, 32):
        out = running_total(df, ["v", "id"], ["w"], ["g"], n_buckets=n).toPandas()
        exp = pdf.sort_values(["g", "v", "id"]).assign(c=lambda d: d.groupby("g").w.cumsum())
        merged = out.merge(exp[["id", "c"]], on="id")
        assert (merged.cum_w == merged.c).all()


def test_split_disjoint_cover_and_partition_independent(spark):
    df = spark.range(5000)
    train, test = hash_split(df, "id", (0.8, 0.2), seed=3)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.77 < len(a) / 5000 < 0.83
    again = {r.id for r in hash_split(df.repartition(7), "id", (0.8, 0.2), seed=3)[0].collect()}
    assert again == a
    labelled = split_label(df, "id", (0.8, 0.2), seed=3).where(F.col("part") == "train")
    assert {r.id for r in labelled.collect()} == a


def test_shuffle_rank_is_a_permutation(spark):
    df = spark.range(3000)
    ranks = [r.shuffle_rank for r in shuffle_rows(df, "id", seed=1, n_buckets=5).collect()]
    assert sorted(ranks) == list(range(1, 3001))
    first = shuffle_rows(df.repartition(3), "id", seed=1).orderBy("shuffle_rank").limit(5).collect()
    second = shuffle_rows(df, "id", seed=1).orderBy("shuffle_rank").limit(5).collect()
    assert [r.id for r in first] == [r.id for r in second]


def test_union_by_name_any_column_order(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(tuple(r) for r in union_slices(a, b).collect()) == [(1, "x"), (2, "y")]


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7), ("a", None, 8)], "g string, v int, w int")
    for n in (1, 3):
        out = {(r.g, r.v): (r.cum_w, r.all_w) for r in
               running_total(df, ["v"], ["w"], ["g"], n_buckets=n, total_prefix="all_").collect()}
        assert out == {(None, 1): (5, 11), (None, 2): (11, 11), ("a", None): (8, 15), ("a", 1): (15, 15)}


def test_null_keys_stay(spark):
    df = spark.range(100).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("k"))
    parts = hash_split(df, "k", (0.8, 0.2))
    assert sum(p.count() for p in parts) == 100
    assert sorted(p.where("k is null").count() for p in parts) == [0, 20]
    tagged = split_label(df, "k", (0.8, 0.2))
    assert tagged.where("part = 'train'").count() == parts[0].count()


def test_equal_and_missing_keys_are_shuffled_too(spark):
    """A third of the rows share a key, a third have none: no bucket holds them all, and ranks repeat."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("v"))
    runs = [{r.v: r.shuffle_rank for r in shuffle_rows(df.repartition(n), "k", seed=5).collect()} for n in (2, 9)]
    assert runs[0] == runs[1] and sorted(runs[0].values()) == list(range(1, 3001))
    # Rows of one key stand together; those without a key are dealt among the others.
    others = sorted((r, v) for v, r in runs[0].items() if v % 3)
    assert 0.4 < sum(v % 3 == 2 for _, v in others[:1000]) / 1000 < 0.6
