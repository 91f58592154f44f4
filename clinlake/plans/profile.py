"""Size-probe queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.features import assemble
from clinlake.operators.models import fit, score, tree
from clinlake.operators.profile import observe_size, observed_sizes, profile_tables, table_size
from clinlake.operators.relate import cohort_join
from clinlake.plans.standins import table
from clinlake.session import kept

PROFILED = ["customer", "orders", "part", "lineitem"]


def q_table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_size(table(spark, sf_dir, "orders"))


def q_profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_tables({name: table(spark, sf_dir, name) for name in PROFILED})


def q_observed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes after load, join, assembly and scoring, all measured by the one job that writes the scores."""
    def build():
        probes = {}

        def probed(name, df):
            df, probes[name] = observe_size(df, name)
            return df

        def assembled(name):
            orders, customer = probed(f"{name}orders", table(spark, sf_dir, "orders")), probed(f"{name}customer", table(spark, sf_dir, "customer"))
            joined = probed(f"{name}joined", cohort_join(orders, customer, ("o_custkey", "c_custkey"), select=[
                "o_orderkey", "o_totalprice", "c_acctbal", "o_orderstatus"]))
            rows = joined.select("o_orderkey", "o_totalprice", "c_acctbal", (F.col("o_orderstatus") == "F").cast("double").alias("late"))
            return probed(f"{name}assembled", assemble(rows, ["o_totalprice", "c_acctbal"]).select("o_orderkey", "late", "features"))

        model = fit(tree(seed=42), assembled("fit ").select("late", "features"), "late")
        probes.clear()  # those of the scoring job are reported
        scored = probed("scored", score(model, assembled(""), ["o_orderkey"], "late"))
        kept(spark, ("observed-scores", sf_dir), lambda: scored)
        return observed_sizes(spark, probes)

    return kept(spark, ("observed-sizes", sf_dir), build)
