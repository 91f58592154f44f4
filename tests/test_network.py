"""Momentum descent on windows of products equals a plain loop; cyclic batches equal a walk through the file."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.operators import network
from clinlake.operators.batches import cyclic_batches, number_rows, steps_per_epoch
from clinlake.sources import read_label_matrix


def _rows(spark, x, y):
    return spark.createDataFrame([(i, int(t), r.tolist()) for i, (r, t) in enumerate(zip(x, y))], "row long, label int, features array<double>")


def _plain(plan, x, y, valid=None):
    """The same descent, step by step on whole matrices."""
    w = np.concatenate([plan.first_weights(b) for b in range(plan.n_blocks)])
    v, head, n = np.zeros_like(w), plan.head(), len(x)
    steps, history = steps_per_epoch(n, plan.batch), []
    for epoch in range(plan.epochs):
        loss, hits = [], []
        for step in range(epoch * steps, (epoch + 1) * steps):
            at = (step * plan.batch + np.arange(plan.batch)) % n
            back, p = head.step(x[at] @ w, y[at], plan.rate_at(step), plan.momentum)
            v = plan.momentum * v - plan.rate_at(step) * (x[at].T @ back)
            w = w + v
            loss.append(-np.log(p[np.arange(len(at)), y[at]]).mean())
            hits.append((p.argmax(axis=1) == y[at]).mean())
        checked = (None, None)
        if valid is not None:
            p = head.forward(valid[0] @ w)[1]
            checked = (-np.log(p[np.arange(len(p)), valid[1]]).mean(), (p.argmax(axis=1) == valid[1]).mean())
        history.append((epoch, np.mean(loss), np.mean(hits), *checked))
    return w, v, head, history


def _layer(spark, net, column):
    found = sorted((r["block"], r[column]) for r in net.state(spark).collect())
    return np.concatenate([np.frombuffer(data).reshape(-1, net.plan.hidden[0]) for _, data in found])


def _data(n, d, classes, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    return rng.normal(0, 1, (n, d)) + 0.7 * np.eye(classes, d)[y] * 3, y


# One window for all epochs; several windows an epoch; a file that ends inside a batch; fewer rows than a batch.
@pytest.mark.parametrize("n, batch, window, epochs", [(70, 16, 1024, 5), (70, 8, 24, 4), (64, 16, 32, 3), (5, 8, 4, 3)])
def test_descent_equals_a_plain_loop(spark, n, batch, window, epochs):
    x, y = _data(n, 23, 3)
    vx, vy = _data(600, 23, 3, seed=9)
    plan = network.Plan(23, 3, hidden=(12, 7), rate=0.05, batch=batch, epochs=epochs, block=10)
    net = network.fit(network.feature_blocks(_rows(spark, x, y), plan), n, plan,
                      network.feature_blocks(_rows(spark, vx, vy), plan), window=window)
    w, v, head, history = _plain(plan, x, y, (vx, vy))
    assert np.allclose(np.array(net.history, float), np.array(history, float), atol=1e-9)
    assert np.allclose(_layer(spark, net, "w"), w, atol=1e-9) and np.allclose(_layer(spark, net, "v"), v, atol=1e-9)
    for a, b in zip([*net.head.weights, *net.head.biases], [*head.weights, *head.biases]):
        assert np.allclose(a, b, atol=1e-9)
    got = sorted((r.row, r.label, r.prediction, *r.probability) for r in network.predict(network.feature_blocks(_rows(spark, vx, vy), plan), net).collect())
    p = head.forward(vx @ w)[1]
    assert len(got) == 600 and np.allclose([g[3:] for g in got], p, atol=1e-9)
    assert [(g[1], g[2]) for g in got] == list(zip(vy.astype(float).tolist(), p.argmax(axis=1).astype(float).tolist()))


# All features in one block: rows stream past it. All epochs in one job; an epoch a job; fewer rows than a batch; one row.
@pytest.mark.parametrize("n, batch, epochs, uses", [(70, 16, 5, 10**6), (70, 8, 4, 1), (64, 16, 3, 130), (5, 8, 3, 20), (1, 4, 2, 1)])
def test_streamed_descent_equals_a_plain_loop(spark, monkeypatch, n, batch, epochs, uses):
    monkeypatch.setattr(network, "STREAM", uses)
    monkeypatch.setattr(network, "_products", lambda *a: pytest.fail("windows are for several blocks"))
    x, y = _data(n, 23, 3)
    vx, vy = _data(600, 23, 3, seed=9)
    plan = network.Plan(23, 3, hidden=(12, 7), rate=0.05, batch=batch, epochs=epochs)
    valid = network.feature_blocks(_rows(spark, vx, vy), plan)
    net = network.fit(network.feature_blocks(_rows(spark, x, y), plan), n, plan, valid)
    w, v, head, history = _plain(plan, x, y, (vx, vy))
    assert np.allclose(np.array(net.history, float), np.array(history, float), atol=1e-9)
    assert np.allclose(_layer(spark, net, "w"), w, atol=1e-9) and np.allclose(_layer(spark, net, "v"), v, atol=1e-9)
    got = sorted((r.row, r.label, r.prediction, *r.probability) for r in network.predict(valid, net).collect())
    p = head.forward(vx @ w)[1]
    assert len(got) == 600 and np.allclose([g[3:] for g in got], p, atol=1e-9)
    assert [(g[1], g[2]) for g in got] == list(zip(vy.astype(float).tolist(), p.argmax(axis=1).astype(float).tolist()))


def test_an_epoch_is_one_job_and_scoring_is_dealt_out(spark, monkeypatch):
    """The number of jobs follows the epochs, not the batches, and rows are scored in more tasks than one."""
    x, y = _data(2000, 6, 2)
    plan = network.Plan(6, 2, hidden=(8, 4), batch=8, epochs=2)
    blocks = network.feature_blocks(_rows(spark, x, y), plan)
    monkeypatch.setattr(network, "STREAM", 1)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("descent", "descent")
    try:
        net = network.fit(blocks, 2000, plan, window=64)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(tracker.getJobIdsForGroup("descent")) < 40  # 250 steps an epoch
    scored = network.predict(blocks, net).withColumn("task", F.spark_partition_id())
    assert scored.select("task").distinct().count() > 1 and scored.count() == 2000


def test_the_network_learns(spark):
    x, y = _data(400, 30, 4)
    plan = network.Plan(30, 4, hidden=(32, 16), rate=0.02, epochs=25)
    net = network.fit(network.feature_blocks(_rows(spark, x, y), plan), 400, plan)
    assert net.history[-1][1] < 0.5 * net.history[0][1] and net.history[-1][2] > 0.8
    table = network.history_table(spark, net)
    assert table.count() == 25 and table.where("val_loss is not null").count() == 0


def test_very_wide_rows_train_in_blocks(spark):
    """All 100,352 inputs are used, and no piece of the first layer is larger than a block."""
    d, n = 100_352, 48
    plan = network.Plan(d, 2, hidden=(16, 4), rate=1e-4, batch=16, epochs=2)
    rows = spark.range(0, n, 1, 8).select(F.col("id").alias("row"), (F.col("id") % 2).cast("int").alias("label"), F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)), lambda j: F.sin(j * 0.001 * (F.col("id") + 1)) + F.when(j % 97 == 0, F.col("id") % 2).otherwise(0)).alias("features"))
    net = network.fit(network.feature_blocks(rows, plan), n, plan)
    j, i = np.arange(d), np.arange(n)
    x = np.sin(j[None, :] * 0.001 * (i[:, None] + 1)) + np.where(j % 97 == 0, 1, 0)[None, :] * (i % 2)[:, None]
    w, _, _, history = _plain(plan, x, i % 2)
    assert np.allclose([h[1] for h in net.history], [h[1] for h in history], atol=1e-8)
    state = net.state(spark)
    assert state.count() == plan.n_blocks == 25
    assert state.agg(F.max(F.octet_length("w"))).first()[0] == network.BLOCK * 16 * 8
    assert np.allclose(_layer(spark, net, "w"), w, atol=1e-8)


def test_rows_of_another_width_fail(spark):
    plan = network.Plan(4, 2, hidden=(3,), batch=2, epochs=1)
    with pytest.raises(Exception, match="has not 4 features"):
        network.feature_blocks(_rows(spark, np.zeros((2, 5)), [0, 1]), plan)
    with pytest.raises(ValueError):
        network.fit(network.feature_blocks(_rows(spark, np.zeros((1, 4)), [0]).limit(0), plan), 0, plan)


@pytest.mark.parametrize("n, batch, epochs", [(70, 32, 4), (64, 32, 2), (5, 8, 3), (33, 1, 2)])
def test_cyclic_batches_walk_through_the_file(spark, n, batch, epochs):
    rows = spark.range(n).withColumnRenamed("id", "row")
    got = sorted(tuple(r) for r in cyclic_batches(rows, n, batch, epochs).collect())
    steps, at, want = max(1, n // batch), 0, []
    for epoch in range(epochs):
        for step in range(steps):
            for place in range(batch):
                want.append((epoch, step, place, at % n))
                at += 1
    assert got == want


def test_matrix_rows_keep_their_place_in_the_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    lines = [f"{i % 2},{i},{i * 2}" for i in range(500)]
    (tmp_path / "m" / "a.csv").write_text("\n".join(lines[:200]) + "\n\n")
    (tmp_path / "m" / "b.csv").write_text("\n".join(lines[200:]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        m = read_label_matrix(spark, str(tmp_path / "m"), place=True)
        numbered = number_rows(m, ["file", "split", "line"])
        assert m.rdd.getNumPartitions() > 3
        got = sorted((r.row, r.label, r.features) for r in numbered.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, i % 2, [float(i), float(2 * i)]) for i in range(500)]
