"""Size-graded scans: filter+count, group counts, previews, delimited and matrix scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators.relate import count_where, group_count, preview, row_count
from clinlake.session import kept_path
from clinlake.sources import read_checked, read_delimited, read_label_matrix, read_profiled, write_delimited, write_label_matrix
from clinlake.plans.standins import stroke_table, table

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def q_filter_item_threshold_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # The item id is a typed literal: the predicate reaches the parquet scan.
    return count_where(events, (F.col("user_id") == F.lit(8)) & (F.col("value") >= F.lit(50.0)))


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "events"))


def q_group_count_high_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(table(spark, sf_dir, "lineitem"), "l_partkey")


def q_group_count_low_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(table(spark, sf_dir, "events"), "event_type")


def q_preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), "o_orderkey", 20)


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as CSV in the shared folder (the delimited source under test), written once per application."""
    return kept_path(spark, ("orders-csv", sf_dir), lambda path: write_delimited(table(spark, sf_dir, "orders"), path))


def q_csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_delimited(spark, _orders_csv(spark, sf_dir), ORDERS_SCHEMA)


def q_csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_delimited(spark, _orders_csv(spark, sf_dir), schema=None)


def q_label_matrix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``embeddings`` as label-first text, scan it back, summarise per label."""
    path = kept_path(spark, ("label-matrix", sf_dir), lambda path: write_label_matrix(
        table(spark, sf_dir, "embeddings"), "label", "embedding", path))
    m = read_label_matrix(spark, path)
    return (m.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("features")).alias("dim"),
        F.round(F.sum(F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)), 4).alias("total")))


def q_csv_scan_profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stroke rows as text with a zero-padded code, scanned with profiled types:
    the code stays text, and the BMI with its ``N/A`` marks is a number."""
    def write(path):
        rows = stroke_table(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))
        write_delimited(rows.select("id", F.lpad(F.col("id").cast("string"), 7, "0").alias("code"), "age", "bmi", "work_type", "stroke"), path)

    return read_profiled(spark, kept_path(spark, ("profiled-csv", sf_dir), write))


CHECKED_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def _faulty_orders(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as delimited text with planted bad records: a price that is
    no number, a missing key, a line cut short."""
    def write(path):
        k = F.col("o_orderkey")
        price = F.when(k % 50 == 1, F.lit("12.5 EUR")).otherwise(F.col("o_totalprice").cast("string"))
        whole = F.concat_ws(",", F.when(k % 70 == 2, F.lit("")).otherwise(k.cast("string")), F.col("o_custkey").cast("string"), price, "o_orderpriority")
        short = F.concat_ws(",", k.cast("string"), F.col("o_custkey").cast("string"))
        rows = table(spark, sf_dir, "orders").select(F.when(k % 60 == 3, short).otherwise(whole).alias(",".join(CHECKED_SCHEMA.names)))
        # One column of whole lines: nothing is quoted, the header is its name.
        rows.write.option("header", True).option("sep", "\u0001").option("quote", "").mode("errorifexists").csv(path)

    return kept_path(spark, ("faulty-orders", sf_dir), write)


def checked_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return read_checked(spark, _faulty_orders(spark, sf_dir), CHECKED_SCHEMA)


def q_checked_scan_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows of a file with planted bad records."""
    return checked_orders(spark, sf_dir)[0]


def q_checked_scan_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined lines: what is wrong with each."""
    return checked_orders(spark, sf_dir)[1].select("reason", "text")
