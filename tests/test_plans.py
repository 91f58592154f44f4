"""Plan-shape checks: pushdown, pruning, no Python on the hot path, no driver pulls."""

import os
import re

from pyspark.sql import functions as F

import __spark_entry__ as E

from conftest import ROOT, SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_parquet_scan(spark):
    plan = _plan(E.queries()["filter_item_threshold_count"](spark, SF01))
    assert re.search(r"PushedFilters: \[[^\]]*user_id", plan)
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_group_count_prunes_columns_and_aggregates_partially(spark):
    plan = E.queries()["group_count_high_card"](spark, SF01)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
    assert "partial_count" in plan


def test_no_python_udfs_or_pair_joins_in_any_sql_checked_plan(spark):
    for name in E.oracle_sql():
        if re.match(r"op\d+_", name) or "forest" in name:
            continue  # those have rules of their own; the forest search is long and scores as the others do
        plan = _plan(E.queries()[name](spark, SF01))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        # statistics are applied as literals: no pair-producing joins anywhere
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_library_never_pulls_data_to_the_driver():
    """Only results whose size is bounded by the schema (marked ``# bounded:``) may be pulled."""
    bad = re.compile(r"\.(collect|toPandas|localCheckpoint)\(|\budf\(|pandas_udf|\.rdd\b")
    hits = []
    for base, folders, files in os.walk(os.path.join(ROOT, "clinlake")):
        folders[:] = [x for x in folders if x != "llm"]  # held to its own rules
        for f in files:
            if f.endswith(".py"):
                for i, line in enumerate(open(os.path.join(base, f)), 1):
                    if bad.search(line) and "# bounded:" not in line:
                        hits.append(f"{f}:{i}: {line.strip()}")
    assert hits == []


def test_cohort_counts_reduce_both_sides_before_the_join(spark):
    from clinlake.operators.relate import cohort_counts
    from clinlake.plans.standins import cohort_predicates, table
    cohorts, events = cohort_predicates()
    orders, customer = table(spark, SF01, "orders"), table(spark, SF01, "customer")
    got = cohort_counts(orders, customer, ("o_custkey", "c_custkey"), cohorts, events)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    assert plan.count("Aggregate [") == 3  # fact side, dimension side, final sum


# Queries whose result is the sum or count of a whole table, or an ordered preview: one small row per task meets in one task.
def test_no_data_sized_rows_meet_in_one_task(spark):
    """Before an exchange to a single partition stands a partial aggregate, a limit,
    or the table of bucket totals."""
    for name in ("impute_median", "seeded_shuffle_rank", "auc_roc", "binary_scorecard", "feature_table_impute", "impute_group_mode",
                 "ratio_round", "edge_bin", "classification_metrics"):
        df = E.queries()[name](spark, SF01)
        df.write.format("noop").mode("overwrite").save()
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1:i + 6])
                assert re.search(r"partial_|LocalLimit|__t_|keys=\[__b", below), (name, below)


def test_long_rankings_split_into_more_buckets(spark, monkeypatch):
    from clinlake.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 100)
    df = spark.range(5000).withColumn("one", F.lit(1).cast("long"))
    out = ranking.running_total(df, ["id"], ["one"])
    assert out.where("cum_one <> id + 1").count() == 0
    assert ranking.in_buckets(df, ["id"]).select("__b").distinct().count() == 50


def test_a_ranking_is_stored_once(spark):
    """One range partitioning, one table."""
    from clinlake import session
    from clinlake.operators import evaluate, ranking
    own = session._OWN.setdefault(spark.sparkContext.applicationId, [])
    before = len(own)
    df = spark.range(5000).select("id", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3 % 2).cast("double").alias("prediction"),
                                  (F.col("id") % 97).cast("double").alias("score"), F.lit(1).cast("long").alias("one"))
    ranking.running_total(df, ["id"], ["one"]).count()
    assert len(own) == before + 1
    evaluate.binary_scorecard(df, "label", "prediction", "score").collect()
    assert len(own) == before + 2
