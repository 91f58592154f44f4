from pyspark.sql import functions as F

from clinlake.operators.relate import (code_join, cohort_counts, cohort_join, conditional_counts,
                                       group_count, preview)


def test_code_join_numeric_and_exact(spark):
    left = spark.createDataFrame([("V3001",), ("0845",), ("00845",), ("4019",)], "code string")
    right = spark.createDataFrame([(845,), (4019,)], "code int")
    assert code_join(left, right, "code", "code", mode="numeric").count() == 3
    assert code_join(left, right, "code", "code", mode="exact").count() == 1


def test_cohort_counts_equals_brute_force(spark):
    # duplicate dimension keys and NULL keys on both sides
    fact = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (None, "a"), (4, "b"), (1, "a")], "k int, ev string")
    dim = spark.createDataFrame(
        [(1, "M"), (1, "F"), (2, None), (3, "X"), (None, "M"), (4, "M")], "k int, g string")
    cohorts = {"M": F.col("g") == "M", "F": F.col("g") == "F",
               "other": ~F.col("g").isin("M", "F")}
    events = {"a": F.col("ev") == "a", "b": F.col("ev") == "b"}
    joined = fact.join(dim, "k")
    preds = {f"{c}|{e}": cp & ep for c, cp in cohorts.items() for e, ep in events.items()}
    brute = conditional_counts(joined, preds).first().asDict()
    got = {(r.cohort, r.event): r.n for r in cohort_counts(fact, dim, "k", cohorts, events).collect()}
    assert got == {tuple(k.split("|")): v for k, v in brute.items()}
    assert len(got) == 6


def test_cohort_counts_single_aggregate_plan(spark):
    fact = spark.range(100).select((F.col("id") % 10).alias("k"), (F.col("id") % 3).alias("e"))
    dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 2).alias("g"))
    df = cohort_counts(fact, dim, "k", {"even": F.col("g") == 0}, {"zero": F.col("e") == 0})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert df.first().n == 17  # ids divisible by 6 below 100


def test_cohort_join_keeps_key_once(spark):
    fact = spark.createDataFrame([(1, "x")], "fk int, v string")
    dim = spark.createDataFrame([(1, "M")], "dk int, g string")
    out = cohort_join(fact, dim, ("fk", "dk"))
    assert out.columns == ["fk", "v", "g"]


def test_group_count_and_preview(spark):
    df = spark.createDataFrame([(k,) for k in "aabbbc"], "k string")
    assert {r.k: r.n for r in group_count(df, "k").collect()} == {"a": 2, "b": 3, "c": 1}
    assert [r.k for r in preview(df, "k", 3).collect()] == ["a", "a", "b"]
