import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clinlake.operators.impute import (class_modes, impute_mean_by, impute_median, impute_mode_by,
                                       medians)


def test_median_even_and_odd(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (10.0, None)], "a double, b double")
    assert medians(df, ["a", "b"]) == {"a": 2.5, "b": 2.0}


def test_median_matches_pandas_with_many_buckets(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 300, 3001).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    for n in (1, 3, 16):
        from clinlake.operators import ranking
        counts = df.groupBy(F.lit("x").alias("__col"), F.col("x").alias("__v")).agg(F.count("*").alias("__n"))
        got = ranking.exact_quantile_rows(counts, "__v", "__n", ["__col"], n_buckets=n).first().median
        assert got == float(np.median(vals))


def test_impute_median_keeps_present_values(spark):
    df = spark.createDataFrame([(1, 150.0), (2, None), (3, 170.0), (4, 160.0)], "id int, h double")
    got = {r.id: r.h for r in impute_median(df, ["h"]).collect()}
    assert got == {1: 150.0, 2: 160.0, 3: 170.0, 4: 160.0}


def test_mean_by_class_and_label_filter(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (0, 3.0), (1, 10.0), (1, None), (2, None)],
                               "y int, x double")
    out = impute_mean_by(df, "y", ["x"]).collect()
    assert sorted((r.y, r.x) for r in out) == [(0, 1.0), (0, 2.0), (0, 3.0), (1, 10.0), (1, 10.0)]


def test_mode_ties_go_to_lowest_value(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (0, None), (1, "c"), (1, "c"), (1, "a"), (1, None)],
                               "y int, g string")
    assert class_modes(df, "y", ["g"]) == {"g": ["a", "c"]}
    filled = impute_mode_by(df, "y", ["g"]).collect()
    assert all(r.g is not None for r in filled)


def test_mode_numeric_orders_by_number(spark):
    df = spark.createDataFrame([(0, 10.0), (0, 9.0)], "y int, v double")
    assert class_modes(df, "y", ["v"], classes=(0,)) == {"v": [9.0]}


def test_mean_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 500), "x": rng.normal(size=500)})
    pdf.loc[rng.choice(500, 60, replace=False), "x"] = np.nan
    df = spark.createDataFrame([(int(a), None if np.isnan(b) else float(b)) for a, b in pdf.values],
                               "y int, x double")
    got = impute_mean_by(df, "y", ["x"]).groupBy("y").agg(F.sum("x").alias("s")).collect()
    for k in (0, 1):
        part = pdf[pdf.y == k].x
        expect = part.fillna(part.mean()).sum()
        assert abs([r.s for r in got if r.y == k][0] - expect) < 1e-9


def test_medians_match_numpy(spark):
    rng = np.random.default_rng(9)
    for n in (2001, 2000):
        vals = np.round(rng.normal(size=n), 2)
        df = spark.createDataFrame([(float(v), float(v) * 2, None) for v in vals], "a double, b double, c double")
        assert medians(df, ["a", "b", "c"]) == {"a": float(np.median(vals)), "b": float(np.median(vals * 2)), "c": None}


def test_whole_number_columns_are_filled_with_fractions(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (0, None)], "y int, x int")
    assert sorted(r.x for r in impute_median(df, ["x"]).collect()) == [1.0, 1.5, 2.0]
    assert sorted(r.x for r in impute_mean_by(df, "y", ["x"]).collect()) == [1.0, 1.5, 2.0]


def test_modes_keep_every_digit(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(0, big), (0, big), (0, None), (0, big - 1)], "y int, x long")
    assert sorted(r.x for r in impute_mode_by(df, "y", ["x"]).collect()) == [big - 1, big, big, big]
    tie = spark.createDataFrame([(0, big), (0, big - 1), (0, None)], "y int, x long")
    assert sorted(r.x for r in impute_mode_by(tie, "y", ["x"]).collect()) == [big - 1, big - 1, big]


def test_statistics_can_be_fitted_on_another_frame(spark):
    from clinlake.operators.clean import equal_width_bin
    train = spark.createDataFrame([(0, 10.0), (0, 20.0), (1, 30.0)], "y int, x double")
    test = spark.createDataFrame([(0, None), (1, None), (0, 25.0)], "y int, x double")
    assert {r.x for r in impute_median(test, ["x"], stats_from=train).collect()} == {20.0, 25.0}
    got = sorted((r.y, r.x) for r in impute_mean_by(test, "y", ["x"], stats_from=train).collect())
    assert got == [(0, 15.0), (0, 25.0), (1, 30.0)]
    bins = equal_width_bin(test, "x", ["a", "b"], "b", stats_from=train).where("x = 25.0").first().b
    assert bins == 1  # range 10..30 from train: 25 is in the upper half
