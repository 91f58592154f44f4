"""Relational cohort analysis: fact x dimension join, cohort counts, code joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions import text_match_any
from clinlake.operators.relate import cohort_counts, cohort_join, code_join, count_where
from clinlake.operators.profile import profile_tables
from clinlake.plans.standins import (cohort_predicates, diagnosis_codes, procedure_codes,
                                     table)


def q_cohort_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohorts, events = cohort_predicates()
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return cohort_counts(orders, customer, ("o_custkey", "c_custkey"), cohorts, events)


def q_inner_equi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return cohort_join(orders, customer, ("o_custkey", "c_custkey"),
                       select=["o_orderkey", "o_custkey", "c_mktsegment", "o_orderpriority",
                               "o_orderstatus"])


def _code_join(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    left = diagnosis_codes(part)
    right = procedure_codes(part, as_text=(mode == "exact"))
    return code_join(left, right, "diag_code", "proc_code", mode=mode,
                     select=["p_partkey", "diag_code", F.col("proc_code").cast("string").alias("proc_code"),
                             "short_title", "long_title"])


def q_code_join_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _code_join(spark, sf_dir, "numeric")


def q_code_join_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _code_join(spark, sf_dir, "exact")


def q_title_match_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined codes whose short or long dictionary title holds a word."""
    return count_where(_code_join(spark, sf_dir, "numeric"), text_match_any(["short_title", "long_title"], "al"))


def q_joined_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and statistics of the two joined tables."""
    return profile_tables({"cohort_join": q_inner_equi_join(spark, sf_dir), "code_join": _code_join(spark, sf_dir, "numeric")})


def q_text_match_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return count_where(part, text_match_any(["p_name", "p_type"], "ring"))
