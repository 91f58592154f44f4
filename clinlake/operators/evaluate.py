"""Classification metrics as DataFrame aggregations.

Everything starts from the confusion matrix (one grouped count, at most
classes^2 rows), so metrics never need the predictions on the driver and can
be checked in SQL.  ROC area is exact and distributed (running totals over
score groups).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.functions import argmax_array
from clinlake.operators.ranking import in_buckets, running_total, totals_within
from clinlake.session import materialize


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     weight: str | None = None) -> DataFrame:
    """``(label, prediction, n)`` counts; with ``weight`` a row counts that often."""
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
            .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n")))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction",
                weight: str | None = None) -> DataFrame:
    """Per class: ``support`` (true count), ``predicted``, ``tp``, precision, recall, f1.

    No join: every confusion cell contributes once as its label (support, tp)
    and once as its prediction (predicted), and one grouped sum per class
    combines them.  Classes seen only as predictions get support 0; a class
    never predicted gets precision 0 (Spark's and sklearn's convention).
    """
    cm = confusion_matrix(df, label, prediction, weight)
    n = F.col("n")
    contrib = F.explode(F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"),
                 F.when(F.col("label") == F.col("prediction"), n).otherwise(F.lit(0).cast("long")).alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), n.alias("predicted"))))
    s = (cm.select(contrib.alias("c")).select("c.*").groupBy("class")
         .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted")))
    p = _ratio(F.col("tp"), F.col("predicted"))
    r = _ratio(F.col("tp"), F.col("support"))
    return (s.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall")
                                     / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           weight: str | None = None) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1
    (weighted recall equals accuracy)."""
    s = class_stats(df, label, prediction, weight)
    n = F.sum("support")
    return s.agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"))


def classification_report(df: DataFrame, names: Sequence[str], label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support plus ``accuracy``, ``macro avg`` and
    ``weighted avg`` rows.  ``names[i]`` names class ``i``.

    One ``rollup`` over the per-class table yields the class rows and the
    grand-total row; the total row is expanded into the three summary rows.
    """
    s = class_stats(df, label, prediction)
    ps, rs, fs = (F.col(c) * F.col("support") for c in ("precision", "recall", "f1"))
    r = s.rollup("class").agg(
        F.first("precision").alias("p"), F.first("recall").alias("r"), F.first("f1").alias("f"),
        F.sum("support").alias("sup"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(ps).alias("wp"), F.sum(rs).alias("wr"), F.sum(fs).alias("wf"),
        F.grouping("class").alias("total"))
    # a class without a name (outside ``names``) gets NULL rather than an ANSI error
    name = F.try_element_at(F.array(*[F.lit(x) for x in names]), (F.col("class").cast("int") + 1))
    nul = F.lit(None).cast("double")
    row = lambda n, p, rc, f: F.struct(n.alias("row_name"), p.alias("precision"), rc.alias("recall"),
                                       f.alias("f1"), F.col("sup").cast("long").alias("support"))
    rows = F.when(F.col("total") == 0, F.array(row(name, F.col("p"), F.col("r"), F.col("f")))).otherwise(
        F.array(row(F.lit("accuracy"), nul, nul, F.col("tp") / F.col("sup")),
                row(F.lit("macro avg"), F.col("mp"), F.col("mr"), F.col("mf")),
                row(F.lit("weighted avg"), F.col("wp") / F.col("sup"), F.col("wr") / F.col("sup"),
                    F.col("wf") / F.col("sup"))))
    return r.select(F.explode(rows).alias("x")).select("x.*")


def auc_roc(df: DataFrame, score: str, label: str, positive=1.0, n_buckets: int | None = None,
            weight: str | None = None) -> DataFrame:
    """Exact area under the ROC curve as a one-row frame ``(auc)``.

    Rows are grouped by score (ties form one ROC step), the count of negatives
    below each score comes from distributed running totals, and
    ``auc = sum(pos * (neg_below + neg/2)) / (P * N)``.  Equals
    ``BinaryClassificationMetrics`` with no binning.
    """
    w = F.col(weight) if weight else F.lit(1).cast("long")
    g = _steps(df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias("__s"), F.col(label).alias("__y"), w.alias("__n")), positive)
    return _area(running_total(g, ["__s"], ["__neg"], n_buckets=n_buckets, prefix="__cum"))


def _steps(rows: DataFrame, positive=1.0, *by: str) -> DataFrame:
    """Positives and negatives of each score (and of each of ``by``)."""
    y = F.col("__y").cast("double") == F.lit(float(positive))
    return rows.groupBy(*by, "__s").agg(F.sum(F.when(y, F.col("__n")).otherwise(0)).alias("__pos"),
                                        F.sum(F.when(y, 0).otherwise(F.col("__n"))).alias("__neg"))


def _area(ranked: DataFrame) -> DataFrame:
    below = (F.col("__cum__neg") - F.col("__neg")).cast("double")
    area = F.sum(F.col("__pos").cast("double") * (below + F.col("__neg").cast("double") / 2))
    return ranked.agg(F.try_divide(area, F.sum("__pos").cast("double") * F.sum("__neg").cast("double")).alias("auc"))


def roc_curve(df: DataFrame, score: str, label: str, positive=1.0, drop_collinear: bool = True) -> DataFrame:
    """``(threshold, fpr, tpr)``: the points of the ROC curve, one per distinct
    score (rows at or above it count as positive), and the origin, whose
    threshold is infinity.

    ``drop_collinear`` leaves out points on a straight line between their
    neighbours; the area does not change.  Counts up to each score are running
    totals, and each point meets the next one by its rank, so no task sees the
    whole curve.  Rows without a score or label are left out; rates without
    any row of their class are NULL.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias("__s"), F.col(label).alias("__y"), F.lit(1).cast("long").alias("__n"))
    steps = _steps(rows, positive).withColumn("__down", -F.col("__s")).withColumn("__one", F.lit(1).cast("long"))
    r = running_total(steps, ["__down"], ["__one", "__pos", "__neg"], prefix="upto", total_prefix="all")
    if drop_collinear:
        r = materialize(r, "roc-steps")
        after = r.select((F.col("upto__one") - 1).alias("__at"), F.col("__pos").alias("__next_pos"), F.col("__neg").alias("__next_neg"))
        r = r.join(after, r["upto__one"] == after["__at"], "left")
        turns = F.col("__pos") * F.col("__next_neg") != F.col("__neg") * F.col("__next_pos")
        r = r.where(F.col("__at").isNull() | turns)
    rate = lambda n: F.try_divide(F.col(f"upto__{n}").cast("double"), F.col(f"all__{n}").cast("double"))
    points = r.select(F.col("__s").alias("threshold"), rate("neg").alias("fpr"), rate("pos").alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def binary_scorecard(df: DataFrame, label: str, prediction: str, score: str, digits: int = 4) -> DataFrame:
    """One row ``(accuracy, precision, roc_auc)`` rounded to ``digits`` places
    (precision is support-weighted).

    The predictions are read once: they are counted per (label, prediction,
    score), and these counts are stored once, in buckets of the score; all
    three figures come from there.
    """
    cells = in_buckets(df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"),
                                  F.col(score).cast("double").alias("__s")).agg(F.count(F.lit(1)).alias("n")), ["__s"])
    m = classification_metrics(cells, "label", "prediction", "n")
    known = cells.where("__s is not null and label is not null").select("__b", "__s", F.col("label").alias("__y"), F.col("n").alias("__n"))
    ranked = totals_within(_steps(known, 1.0, "__b"), ["__s"], ["__neg"], prefix="__cum")
    auc = _area(ranked).first().auc  # bounded: one row
    return m.select(F.round("accuracy", digits).alias("accuracy"),
                    F.round("weighted_precision", digits).alias("precision"),
                    F.round(F.lit(auc).cast("double"), digits).alias("roc_auc"))


def scored_facts(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What must hold of every scored row whatever the model learned: ``keys``,
    the label, ``n_classes``, ``probability_sum`` (6 places),
    ``prediction_is_argmax`` and, for binary models, ``score_is_positive``."""
    p = F.col("probability")
    binary = [(F.col("score") == F.element_at(p, 2)).alias("score_is_positive")] if "score" in preds.columns else []
    return preds.select(
        *keys, "label", F.size(p).alias("n_classes"),
        F.round(F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x), 6).alias("probability_sum"),
        (F.col("prediction") == argmax_array(p)).alias("prediction_is_argmax"), *binary)


def misclassified(df: DataFrame, label: str, prediction: str, cols: Sequence[str],
                  n: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows whose prediction differs from the label, with ``cols``; optionally the
    first ``n`` by ``order_by`` (a preview)."""
    out = df.where(F.col(prediction) != F.col(label)).select(*cols)
    if n is not None:
        out = out.orderBy(*(order_by or cols[:1])).limit(n)
    return out

