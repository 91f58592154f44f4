"""Category dictionaries of columns with very many values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.dictionary import category_dictionary, encode
from clinlake.plans.standins import table
from clinlake.session import kept


def order_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a category that a third of the rows share; the others have one for every few rows."""
    k = F.col("o_orderkey")
    category = F.when(k % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.floor(k / 4).cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", category.alias("category"), "o_orderpriority")


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, ("order-dictionary", sf_dir), lambda: category_dictionary(order_categories(spark, sf_dir), ["category", "o_orderpriority"]))


def q_category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of both columns with its count and its code."""
    return _dictionary(spark, sf_dir)


def q_category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of every row, joined back from the dictionary."""
    coded = encode(order_categories(spark, sf_dir), ["category", "o_orderpriority"], _dictionary(spark, sf_dir))
    return coded.select("o_orderkey", "category_label", "o_orderpriority_label")
