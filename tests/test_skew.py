"""A key that holds a third of all fact rows: results stay exact on every plan."""

from pyspark.sql import functions as F

from clinlake.operators.relate import cohort_counts, conditional_counts, group_count
from clinlake.plans.standins import cohort_predicates, table
from conftest import SF01


def _skewed_orders(spark):
    orders = table(spark, SF01, "orders")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey"))
    return orders.withColumn("o_custkey", hot)


def test_cohort_counts_exact_under_a_hot_key(spark):
    orders, customer = _skewed_orders(spark), table(spark, SF01, "customer")
    cohorts, events = cohort_predicates()
    on = ("o_custkey", "c_custkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    brute = conditional_counts(joined, {f"{c}|{e}": cp & ep for c, cp in cohorts.items()
                                        for e, ep in events.items()}).first().asDict()
    expect = {tuple(k.split("|")): v for k, v in brute.items()}
    got = {(r.cohort, r.event): r.n for r in cohort_counts(orders, customer, on, cohorts, events).collect()}
    assert got == expect


def test_group_count_hot_key_combined_map_side(spark):
    orders = _skewed_orders(spark)
    counts = group_count(orders, "o_custkey")
    assert counts.where("o_custkey = 0").first().n >= orders.count() // 3
    assert counts.agg(F.sum("n")).first()[0] == orders.count()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # one row per key per task crosses the shuffle
