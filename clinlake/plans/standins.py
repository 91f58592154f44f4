"""Clinical stand-in tables derived from the driver's parquet tables.

The clinical source files are not available, so each workload runs on a
table Spark derives from the given ones.  Missing values, sentinels and text
markers are injected by deterministic integer rules on keys, so the SQL
oracle can rebuild exactly the same rows.  All rules use integer arithmetic
(no float rounding) to keep both engines bit-identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions import is_neither

# Names of the cohort and event predicates of the cohort analysis.
COHORTS = ("BUILDING", "MACHINERY", "other")
EVENTS = ("urgent", "finished")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- cohort analysis (admissions x patients) ---------------------------------

def cohort_predicates():
    """Cohorts on ``customer`` (gender role), events on ``orders`` (admission role)."""
    seg = F.col("c_mktsegment")
    cohorts = {
        "BUILDING": seg == "BUILDING",
        "MACHINERY": seg == "MACHINERY",
        "other": is_neither(seg, ["BUILDING", "MACHINERY"]),
    }
    events = {
        "urgent": F.col("o_orderpriority") == "1-URGENT",
        "finished": F.col("o_orderstatus") == "F",
    }
    return cohorts, events


# --- diagnosis codes x procedure dictionary ----------------------------------

def diagnosis_codes(part: DataFrame) -> DataFrame:
    """Text codes: alphanumeric ``'V'||size``, plain digits, or zero-padded digits."""
    size = F.col("p_size").cast("string")
    code = (F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("V"), size))
            .when(F.col("p_partkey") % 3 == 0, size)
            .otherwise(F.lpad(size, 4, "0")))
    return part.select("p_partkey", code.alias("diag_code"), "p_name", "p_type")


def procedure_codes(part: DataFrame, as_text: bool) -> DataFrame:
    """Dictionary of distinct sizes with two titles, typed as int (inferred-style) or 4-digit text."""
    size = F.col("p_size")
    code = F.lpad(size.cast("string"), 4, "0") if as_text else size
    return part.groupBy(code.alias("proc_code")).agg(F.min("p_type").alias("short_title"), F.max("p_name").alias("long_title"))


# --- stroke table (customer + urgent-order counts) ---------------------------

def stroke_table(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Stroke-style rows: text BMI with ``N/A`` markers, double age/glucose,
    five categorical columns and a 0/1 label (customer has >= 3 urgent orders).

    The label needs one row per customer from ``orders``: a grouped count
    (partial aggregation, one shuffle row per key) joined on the key.
    """
    urgent = (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent")))
    k = F.col("c_custkey")
    nat = F.col("c_nationkey")
    t = (k * 37) % 300
    bmi_text = F.concat((F.lit(15) + F.floor(t / 10)).cast("string"), F.lit("."), (t % 10).cast("string"))
    return (customer.join(urgent, "c_custkey", "left").select(
        k.alias("id"),
        F.when(nat % 10 == 9, "Other").when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        ((k % 80) + 1).cast("double").alias("age"),
        F.when(k % 5 == 0, 1).otherwise(0).alias("hypertension"),
        F.when(nat % 4 == 0, 1).otherwise(0).alias("heart_disease"),
        F.when(k % 3 == 0, "No").otherwise("Yes").alias("ever_married"),
        F.col("c_mktsegment").alias("work_type"),
        F.when(nat % 2 == 0, "Urban").otherwise("Rural").alias("Residence_type"),
        (F.lit(55.0) + ((k * 53) % 2000).cast("double") / F.lit(10.0)).alias("avg_glucose_level"),
        F.when(k % 13 == 0, F.lit("N/A")).otherwise(bmi_text).alias("bmi"),
        F.when(k % 7 <= 2, "never smoked").when(k % 7 <= 4, "Unknown")
        .when(k % 7 == 5, "formerly smoked").otherwise("smokes").alias("smoking_status"),
        F.when(F.coalesce(F.col("n_urgent"), F.lit(0)) >= 3, 1).otherwise(0).alias("stroke"),
    ))


# --- ICU table (orders x customer) -------------------------------------------

# Label and id column of the ICU file.
ICU_LABEL = "In-hospital_death"
ICU_ID = "RecordID"


def icu_table(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """ICU-style rows with -1 / +inf sentinels, NULLs, zero heights, and one
    whole-number column with gaps (Height)."""
    ok = F.col("o_orderkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select(
        ok.alias("RecordID"),
        F.when(ok % 17 == 0, F.lit(-1.0)).when(ok % 53 == 0, F.lit(float("inf")))
        .otherwise((F.lit(16) + F.col("c_custkey") % 75).cast("double")).alias("Age"),
        (F.col("c_nationkey") % 2).cast("double").alias("Gender"),
        (F.lit(1) + F.col("c_nationkey") % 4).cast("double").alias("ICUType"),
        F.when(ok % 11 == 0, F.lit(None)).when(ok % 97 == 0, 0)
        .otherwise(F.lit(150) + F.col("o_custkey") % 50).cast("int").alias("Height"),
        F.when(ok % 11 == 1, F.lit(-1.0))
        .otherwise((F.lit(40) + ok % 80).cast("double")).alias("Weight"),
        F.when(ok % 7 == 3, F.lit(None).cast("double"))
        .otherwise(F.lit(60.0) + (ok % 600).cast("double") / F.lit(10.0)).alias("HR"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(ICU_LABEL),
    )


# --- rule-based predictions (metric inputs) -----------------------------------

def rule_predictions(orders: DataFrame) -> DataFrame:
    """Label = high priority, prediction = expensive order, score = total price."""
    p1 = F.least(F.col("o_totalprice") / F.lit(500000.0), F.lit(1.0))
    return orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") <= "2-HIGH", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("o_totalprice") > 250000, 1.0).otherwise(0.0).alias("prediction"),
        F.col("o_totalprice").alias("score"),
        F.array(F.lit(1.0) - p1, p1).alias("probability"),
    )
