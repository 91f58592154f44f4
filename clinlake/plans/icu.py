"""ICU mortality workload: sentinel cleaning, binning, imputation, features.

The original ran this block in pandas on the driver after ``toPandas()``;
here every step is a distributed DataFrame expression or aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions import ratio_round
from clinlake.operators.clean import edge_bin, equal_width_bin, min_max, null_sentinels
from clinlake.operators.evaluate import binary_scorecard, scored_facts
from clinlake.operators.features import as_array, assemble, feature_columns, index_categories
from clinlake.operators.impute import (class_mean_columns, impute_mean_by, impute_median, impute_mode_by,
                                      medians, read_class_means)
from clinlake.operators.split import shuffle_rows, split_label, union_slices
from clinlake.plans.standins import ICU_ID, ICU_LABEL, icu_table, table
from clinlake.session import kept, materialize

# Bin labels, BMI edges, categorical columns, label classes and
# train/test weights of the ICU recipe.
AGE_LABELS = ["<20", "20s", "30s", "40s", "50s", "60s", "70s", "80s", "90s"]
BMI_EDGES = [18.5, 24.9, 29.9]
BMI_LABELS = ["Underweight", "Healthy", "Overweight", "Obesity"]
CATEGORICAL = ["Gender", "ICUType", "age_group", "bmi_group"]
CLASSES = (0, 1)
SPLIT = (0.8, 0.2)
SEED = 42


def icu_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in table, stored once for all queries of an application."""
    return kept(spark, ("icu-source", sf_dir), lambda: icu_table(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")))


def icu_clean(src: DataFrame) -> DataFrame:
    """Sentinels to NULL on every numeric column."""
    return null_sentinels(src)


def _icu_fit(src: DataFrame, label: str = ICU_LABEL, id_col: str = ICU_ID, stats_from: DataFrame | None = None):
    """Prepared table plus the class means fitted on it (or on ``stats_from``,
    e.g. the training part, which then goes through the same steps).

    Statistics that depend on the same input share one pass.  The input should
    be a stored table: everything here is a chain of projections over it with
    fitted values inlined as literals.
    """
    frames = [icu_clean(src)] + ([icu_clean(stats_from)] if stats_from is not None else [])
    each = lambda step: [step(d) for d in frames]  # noqa: E731  frames[-1] is what statistics are fitted on
    bounds = min_max(frames[-1], "Age")
    frames = each(lambda d: equal_width_bin(d, "Age", AGE_LABELS, "__age_bin", "age_group", bounds=bounds).drop("__age_bin"))
    found = medians(frames[-1], ["Height", "Weight"])
    frames = each(lambda d: impute_median(d, ["Height", "Weight"], values=found).withColumn("bmi", ratio_round("Weight", "Height")))
    _, num = feature_columns(frames[-1], CATEGORICAL + ["bmi"], [id_col, label])
    second = frames[-1].agg(F.min("bmi").cast("double").alias("lo"), F.max("bmi").cast("double").alias("hi"),
                            *class_mean_columns(label, num, CLASSES)).first()  # bounded: one row
    frames = each(lambda d: edge_bin(d, "bmi", BMI_EDGES, BMI_LABELS, "bmi_group", bounds=(second.lo, second.hi)).drop("bmi"))
    return frames, read_class_means(second, num, CLASSES)


def icu_prepared(src: DataFrame, label: str = ICU_LABEL, id_col: str = ICU_ID) -> DataFrame:
    """Sentinels -> age bins -> median fill -> BMI -> BMI bins (BMI itself dropped)."""
    return _icu_fit(src, label, id_col)[0][0]


def icu_imputed(src: DataFrame, label: str = ICU_LABEL, id_col: str = ICU_ID, stats_from: DataFrame | None = None) -> list[DataFrame]:
    """The prepared table with class-mean (numeric) and class-mode (categorical)
    fills, and the same for ``stats_from`` where given."""
    frames, means = _icu_fit(src, label, id_col, stats_from)
    cat, num = feature_columns(frames[0], CATEGORICAL, [id_col, label])
    frames = [impute_mean_by(d, label, num, CLASSES, means=means) for d in frames]
    return [impute_mode_by(d, label, cat, CLASSES, stats_from=frames[-1]) for d in frames]


def icu_features(src: DataFrame, drop_id: bool = True, dedupe: bool = True, label: str = ICU_LABEL, id_col: str = ICU_ID,
                 stats_from: DataFrame | None = None) -> DataFrame:
    """Assembled ICU feature table.

    ``drop_id=False, dedupe=False`` reproduces the original column list
    (record id assembled, and each bin group present twice: as the int code
    that replaced the text and as the index column); the defaults drop both.
    ``stats_from`` (e.g. the training part) is what all statistics and
    category codes are fitted on; by default the table itself, as in the
    original.
    """
    frames = icu_imputed(src, label, id_col, stats_from)
    d = index_categories(frames[0], ["age_group", "bmi_group"], stats_from=frames[-1])
    if dedupe:
        d = d.drop("age_group", "bmi_group")
    else:
        d = d.withColumns({"age_group": F.col("age_group_label"), "bmi_group": F.col("bmi_group_label")})
    cols = [c for c in d.columns if c != label and not (drop_id and c == id_col)]
    return assemble(d, cols)


def _r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


def q_sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icu_clean(icu_source(spark, sf_dir))


def q_equal_width_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = equal_width_bin(icu_clean(icu_source(spark, sf_dir)), "Age", AGE_LABELS, "age_bin", "age_group")
    return d.select("RecordID", "Age", "age_bin", "age_group")


def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = impute_median(icu_clean(icu_source(spark, sf_dir)), ["Height", "Weight"])
    return d.select("RecordID", *_r6("Height", "Weight"))


def q_ratio_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = impute_median(icu_clean(icu_source(spark, sf_dir)), ["Height", "Weight"])
    return d.select("RecordID", ratio_round("Weight", "Height").alias("bmi"))


def q_edge_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = impute_median(icu_clean(icu_source(spark, sf_dir)), ["Height", "Weight"])
    d = d.withColumn("bmi", ratio_round("Weight", "Height"))
    return edge_bin(d, "bmi", BMI_EDGES, BMI_LABELS, "bmi_group").select("RecordID", "bmi", "bmi_group")


def q_impute_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = impute_mean_by(icu_clean(icu_source(spark, sf_dir)), ICU_LABEL, ["Age", "Height", "Weight", "HR"],
                       CLASSES)
    return d.select("RecordID", ICU_LABEL, *_r6("Age", "Height", "Weight", "HR"))


def q_impute_group_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = impute_mode_by(icu_prepared(icu_source(spark, sf_dir)), ICU_LABEL, CATEGORICAL, CLASSES)
    return d.select("RecordID", ICU_LABEL, "Gender", "ICUType", "age_group", "bmi_group")


def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = icu_clean(icu_source(spark, sf_dir))
    lab = F.col(ICU_LABEL)
    slice0 = d.where(lab == 0)
    slice1 = d.where(lab == 1).select(*reversed(d.columns))
    return union_slices(slice0, slice1)


def q_seeded_shuffle_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = icu_source(spark, sf_dir).select("RecordID")
    return shuffle_rows(d, "RecordID", seed=SEED)


def q_feature_table_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = as_array(icu_features(icu_source(spark, sf_dir)), "features")
    return d.select("RecordID", ICU_LABEL, F.transform("features", lambda x: F.round(x, 6)).alias("features"))


def q_feature_table_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original column list: the record id and both forms of the bin groups are assembled."""
    d = as_array(icu_features(icu_source(spark, sf_dir), drop_id=False, dedupe=False), "features")
    return d.select("RecordID", ICU_LABEL, F.transform("features", lambda x: F.round(x, 6)).alias("features"))


def icu_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the tuned logistic regression (fitted once per application)."""
    from clinlake.operators.models import LR_GRID, logistic, score, tune

    def build():
        # Feature table stored once; train/test are deterministic filters of it.
        d = materialize(split_label(icu_features(icu_source(spark, sf_dir)), "RecordID", SPLIT, seed=SEED), "icu-features")
        model = tune(logistic(), LR_GRID, d.where(F.col("part") == "train"), ICU_LABEL, seed=SEED, stabilize=False)
        return score(model, d.where(F.col("part") == "test"), ["RecordID"], ICU_LABEL)

    return kept(spark, ("icu-predictions", sf_dir), build)


def q_icu_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_facts(icu_predictions(spark, sf_dir), ["RecordID"])


def q_icu_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuned logistic regression on the ICU features: accuracy, precision, ROC area."""
    return binary_scorecard(icu_predictions(spark, sf_dir), "label", "prediction", "score")
