"""Public helpers not exercised by the registered queries."""

import os

from clinlake import session
from clinlake.operators.features import index_categories
from clinlake.operators.impute import medians


def test_keep_nominal_keeps_double_codes_with_metadata(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "v string")
    out = index_categories(df, ["v"], keep_nominal=True)
    assert dict(out.dtypes)["v_label"] == "double"
    assert out.schema["v_label"].metadata.get("ml_attr", {}).get("type") == "nominal"
    cast = index_categories(df, ["v"])
    assert dict(cast.dtypes)["v_label"] == "int" and not cast.schema["v_label"].metadata


def test_approximate_median_option(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "x double")
    assert medians(df, ["x"], approx=True) == {"x": 50.0}
    assert medians(df, ["x"]) == {"x": 50.0}


def test_derived_folders_are_shared_and_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_OWN", {})
    monkeypatch.setattr(session, "_KEPT", {})
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    first, second = (session.kept(spark, ("numbers", "dir"), build) for _ in range(2))
    assert first.count() == second.count() == 3 and built == [1]
    folder = first.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[-1].replace("//", "/")
    assert os.path.isdir(folder)
    assert session.cleanup(spark) == 1 and not os.path.exists(folder)
    assert session.kept(spark, ("numbers", "dir"), build).count() == 3 and built == [1, 1]
    session.cleanup(spark)
