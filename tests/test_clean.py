import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clinlake.operators.clean import (constant_fill, edge_bin, equal_width_bin, interaction_features,
                                      null_sentinels)


def test_equal_width_bins_k9(spark):
    df = spark.createDataFrame([(v,) for v in [15.0, 20.0, 24.0, 33.0, 60.0, 90.0, None]], "x double")
    labels = [str(i) for i in range(9)]
    got = [r.b for r in equal_width_bin(df, "x", labels, "b").collect()]
    assert got == [0, 0, 1, 2, 5, 8, None]


def test_equal_width_matches_pandas_cut(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.uniform(-50, 250, 2000), 2)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i long, x double")
    got = {r.i: r.b for r in equal_width_bin(df, "x", [str(i) for i in range(9)], "b").collect()}
    expect = pd.cut(pd.Series(vals), bins=9, labels=False)
    assert all(got[i] == int(expect[i]) for i in range(len(vals)))


def test_equal_width_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert {r.b for r in equal_width_bin(df, "x", list("abcdefghi"), "b").collect()} == {4}


def test_edge_bins_with_data_driven_ends(spark):
    df = spark.createDataFrame([(v,) for v in [15.0, 18.5, 18.51, 24.9, 29.9, 40.0, None]], "x double")
    out = edge_bin(df, "x", [18.5, 24.9, 29.9], ["Underweight", "Healthy", "Overweight", "Obesity"], "g")
    assert [r.g for r in out.collect()] == [None, "Underweight", "Healthy", "Healthy", "Overweight",
                                            "Obesity", None]


def test_edge_bins_raise_when_edges_do_not_increase(spark):
    df = spark.createDataFrame([(20.0,), (40.0,)], "x double")
    with pytest.raises(ValueError, match="must increase"):
        edge_bin(df, "x", [18.5, 24.9, 29.9], ["a", "b", "c", "d"], "g")


def test_sentinels_and_nan_become_null(spark):
    df = spark.createDataFrame([(-1.0, 1), (float("inf"), -1), (float("-inf"), 3), (float("nan"), 4),
                                (2.5, 5)], "x double, y int")
    got = null_sentinels(df).collect()
    assert [r.x for r in got] == [None, None, None, None, 2.5]
    assert [r.y for r in got] == [1, None, 3, 4, 5]


def test_constant_fill_fills_null_and_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (3.0,)], "x double")
    assert [r.x for r in constant_fill(df, {"x": 28.0}).collect()] == [28.0, 28.0, 3.0]


def test_interaction_features_no_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000, 3, 30, 100)], "a int, b int, c int, d int")
    r = interaction_features(df, ("a", "b", "f"), ("c", "d", "s")).first()
    assert r.f == 6_000_000_000 and math.isclose(r.s, 3.0)


def test_equal_width_edges_are_those_of_pandas(spark):
    """Random one-decimal values, where a formula per value differs on the edges."""
    rng = np.random.default_rng(12)
    for k in range(6):
        vals = np.round(rng.uniform(0, 100, 4000), 1)
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i long, x double")
        got = {r.i: r.b for r in equal_width_bin(df, "x", [str(i) for i in range(9)], "b").collect()}
        expect = pd.cut(pd.Series(vals), bins=9, labels=False)
        assert all(got[i] == int(expect[i]) for i in range(len(vals)))
    df = spark.createDataFrame([(33.6,), (0.5,), (99.8,)], "x double")
    assert [r.b for r in equal_width_bin(df, "x", [str(i) for i in range(9)], "b").collect()] == [2, 0, 8]


def test_sentinels_go_from_every_numeric_column(spark):
    df = spark.createDataFrame([(1, -1.0, -1, "x"), (2, float("inf"), 3, "-1")], "id long, a double, b int, c string")
    assert [tuple(r) for r in null_sentinels(df).collect()] == [(1, None, None, "x"), (2, None, 3, "-1")]
