from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions import (argmax_array, hash_bucket, is_neither, ratio_round, text_match_any,
                                to_int)
from clinlake.operators.clean import age_bands


def test_tolerant_int_cast(spark):
    df = spark.createDataFrame([("36.6",), ("N/A",), ("28",), ("-3.7",), (None,)], "v string")
    got = [r[0] for r in df.select(to_int("v")).collect()]
    assert got == [36, None, 28, -3, None]


def test_age_bands_open_boundary(spark):
    df = spark.createDataFrame([(29,), (30,), (31,), (39,), (40,), (None,)], "age int")
    got = [r[0] for r in df.select(age_bands("age")).collect()]
    assert got == ["Adult", "OldAge", "MiddleAge", "MiddleAge", "OldAge", "OldAge"]


def test_neither_nor_excludes_null(spark):
    df = spark.createDataFrame([(None,), ("M",), ("X",)], "g string")
    assert df.where(is_neither("g", ["F", "M"])).count() == 1


def test_ratio_round_half_even_and_zero(spark):
    df = spark.createDataFrame([(0.125, 1.0), (2.675, 1.0), (1.005, 1.0), (5.0, 0.0)], "w double, h double")
    got = [r[0] for r in df.select(ratio_round("w", "h", scale=1.0)).collect()]
    assert got == [0.12, 2.67, 1.0, None]  # as Python rounds the binary values


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],), ([5.0],)], "a array<double>")
    assert [r[0] for r in df.select(argmax_array("a")).collect()] == [1, 0]


def test_text_match_any_case_sensitive(spark):
    df = spark.createDataFrame([("thyroid gland", "x"), ("Thyroid", "y"), ("a", "hypothyroidism")],
                               "s string, l string")
    assert df.where(text_match_any(["s", "l"], "thyroid")).count() == 2


def test_hash_bucket_is_deterministic(spark):
    df = spark.range(1000)
    a = df.select(hash_bucket("id", 7).alias("b")).collect()
    b = df.repartition(5).select("id", hash_bucket("id", 7).alias("b")).orderBy("id").select("b").collect()
    assert a == b
    assert all(0 <= r.b < 10000 for r in a)


def test_ratio_rounds_as_python_does(spark):
    import random

    from clinlake.functions import ratio_round, round_exact
    rng = random.Random(4)
    pairs = [(rng.randint(200, 2500) / 10, rng.randint(100, 210)) for _ in range(20000)] + [(30.1, 200), (0.0, 5), (-30.1, 200)]
    df = spark.createDataFrame([(float(w), float(h)) for w, h in pairs], "w double, h double")
    got = [r[0] for r in df.select(ratio_round("w", "h")).collect()]
    assert got == [round((w / (h ** 2)) * 10000, 2) for w, h in pairs]
    values = [2.675, 0.125, 0.375, 1.005, -2.5, 1e17, 0.5, 1.5, 2.5, -0.045]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        assert [r[0] for r in frame.select(round_exact("x", digits)).collect()] == [round(v, digits) for v in values]
