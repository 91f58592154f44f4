"""How many forests of a grid grow on the driver at once."""

from clinlake.operators import models


def test_forests_that_fill_the_heap_are_fitted_one_by_one(spark, monkeypatch):
    rows = spark.range(2000)
    monkeypatch.setattr(models, "default_parallelism", lambda train, n: min(6, n))
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    one = models.forest_bytes(2000, models.RF_GRID)
    assert one == 60 * 2 * 2000 * models.NODE_BYTES
    assert models.forest_parallelism(rows, models.RF_GRID) == max(1, min(6, heap // 2 // one))
    for share, fits in ((1, 1), (3, 1), (4, 2), (10, 5), (100, 6)):
        monkeypatch.setattr(models, "NODE_BYTES", heap / share / (60 * 2 * 2000) * 0.99)
        assert models.forest_parallelism(rows, models.RF_GRID) == fits


def test_a_forest_is_no_larger_than_its_depth_or_its_rows_allow():
    small = {"maxDepth": [3], "numTrees": [5]}
    assert models.forest_bytes(10**9, small) == 5 * 2 * 8 * models.NODE_BYTES
    assert models.forest_bytes(7, small | {"minInstancesPerNode": [5, 2]}) == 5 * 2 * 4 * models.NODE_BYTES
    assert models.forest_bytes(0, small) > 0


def test_the_search_of_forests_asks_for_that_many(spark, monkeypatch):
    from clinlake.plans import stroke

    class Found(Exception):
        pass

    def tune(*args, parallelism=None, **rest):
        raise Found(parallelism)

    monkeypatch.setattr(stroke, "tune", tune)
    monkeypatch.setattr(stroke, "stroke_train_test", lambda *a: (spark.range(10), None))
    monkeypatch.setattr(stroke, "forest_parallelism", lambda train, spec: 3)
    monkeypatch.setattr(stroke, "kept", lambda spark, key, build: build())
    for search, at_once in ((stroke._forest, 3), (stroke._logistic, None)):
        try:
            search(spark, "nowhere")
        except Found as e:
            assert e.args == (at_once,)
        else:
            raise AssertionError
