"""Feature recipes end to end on the smallest tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clinlake.plans import icu, stroke
from conftest import SF001


def test_stroke_features_shape_and_no_nulls(spark):
    d = stroke.stroke_features(stroke.stroke_source(spark, SF001))
    assert d.columns == ["id", *stroke.FEATURES, "stroke", "features"]
    sizes = {r.n for r in d.select(F.size(vector_to_array("features")).alias("n")).collect()}
    assert sizes == {10}
    assert d.where(F.col("bmi").isNull()).count() == 0


def test_icu_features_default_and_parity(spark):
    src = icu.icu_source(spark, SF001)
    default = icu.icu_features(src)
    parity = icu.icu_features(src, drop_id=False, dedupe=False)
    size = lambda df: {r.n for r in df.select(F.size(vector_to_array("features")).alias("n")).collect()}  # noqa
    assert size(default) == {8} and size(parity) == {11}
    imputed = icu.icu_imputed(src)[0]
    nulls = imputed.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in imputed.columns]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls
    assert {r[0] for r in imputed.select(icu.ICU_LABEL).distinct().collect()} <= {0, 1}


def test_recipes_fit_on_the_training_part(spark):
    """With ``stats_from`` the test rows leave no trace in the statistics."""
    src = icu.icu_source(spark, SF001)
    train = src.where(F.col("RecordID") % 5 != 0)
    alone = {r.RecordID: r.features for r in icu.icu_features(train).select("RecordID", "features").collect()}
    fitted = {r.RecordID: r.features for r in icu.icu_features(src, stats_from=train).select("RecordID", "features").collect()}
    assert alone.keys() < fitted.keys()
    # Class means are sums of doubles, whose last digits depend on the order.
    assert all(max(abs(a - b) for a, b in zip(alone[i], fitted[i])) < 1e-9 for i in alone)
    s = stroke.stroke_source(spark, SF001)
    part = s.where("id % 5 <> 0")
    alone = {r.id: r.features for r in stroke.stroke_features(part).collect()}
    fitted = {r.id: r.features for r in stroke.stroke_features(s, stats_from=part).collect()}
    assert all(alone[i] == fitted[i] for i in alone) and len(fitted) > len(alone)
