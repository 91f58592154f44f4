"""Feed-forward classifier trained by mini-batch descent with momentum.

Dense layers with relu and a softmax on top, trained batch by batch in file
order (`batches`).  Inputs may be very wide (100,352 features), so the first
layer never stands in one place: features are cut into blocks, and the layer's
weights and velocities are a stored table with one row per block.

Steps depend on each other, but a step changes the first layer only by its own
rows: W(t) = W(0) + a V(0) - X' P, where X are the rows of a window of steps.
So a window needs from the wide side only X W(0), X V(0) and the products of
its rows with each other, which one Spark job sums over the feature blocks;
the steps of the window then run on these small matrices, exactly as plain
descent would, and a second job moves every block of weights at once.  What
reaches the driver is bounded by the window, the hidden widths and the
classes, and does not grow with the rows or the features.

Where all features fit in one block there is no wide side: one task holds the
layer and takes step after step while the rows stream past it in file order,
whole epochs a job.  The steps and results are the same.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinlake.operators.batches import steps_per_epoch
from clinlake.session import derived_path, discard, materialize

# Features of one block, rows of one window, and rows scored together.
BLOCK = 4096
WINDOW = 1024
CHUNK = 256
# Uses of rows that one job streams past a layer of one block (an epoch at least),
# and bytes of layers that are copied to score rows in several tasks.
STREAM = 1 << 18
COPIES = 1 << 28

_STATE = "block int, w binary, v binary"


@dataclass
class Plan:
    """What is trained, and how.  The defaults of the numbers are those of the original classifier."""

    n_features: int
    n_classes: int
    hidden: Sequence[int] = (256, 16)
    rate: float = 1e-3
    momentum: float = 0.9
    decay: float = 1e-3 / 25
    batch: int = 32
    epochs: int = 25
    seed: int = 42
    block: int = BLOCK

    @property
    def n_blocks(self) -> int:
        return -(-self.n_features // self.block)

    def width(self, block: int) -> int:
        return min(self.block, self.n_features - block * self.block)

    def rate_at(self, step: int) -> float:
        """The learning rate of a step: it decays with the number of steps before."""
        return self.rate / (1 + self.decay * step)

    def first_weights(self, block: int) -> np.ndarray:
        """Initial weights of a feature block, the same wherever they are drawn (uniform, scaled by both widths)."""
        limit = np.sqrt(6 / (self.n_features + self.hidden[0]))
        return np.random.default_rng([self.seed, block]).uniform(-limit, limit, (self.width(block), self.hidden[0]))

    def head(self) -> "Head":
        widths = [*self.hidden, self.n_classes]
        rng = np.random.default_rng([self.seed, self.n_blocks, 1])
        limits = [np.sqrt(6 / (a + b)) for a, b in zip(widths[:-1], widths[1:])]
        weights = [rng.uniform(-x, x, (a, b)) for x, a, b in zip(limits, widths[:-1], widths[1:])]
        biases = [np.zeros(w) for w in widths]
        return Head(weights, biases, [np.zeros_like(w) for w in weights], [np.zeros_like(b) for b in biases])


@dataclass
class Head:
    """All layers behind the first product: biases of every layer, weights of
    the second layer on, and their velocities.  Its size is that of the hidden widths."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]
    weight_speed: list[np.ndarray]
    bias_speed: list[np.ndarray]

    def forward(self, z: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Outputs of the hidden layers and class probabilities, from the first layer's products."""
        outs = [np.maximum(z + self.biases[0], 0)]
        for w, b in zip(self.weights[:-1], self.biases[1:-1]):
            outs.append(np.maximum(outs[-1] @ w + b, 0))
        last = outs[-1] @ self.weights[-1] + self.biases[-1]
        p = np.exp(last - last.max(axis=1, keepdims=True))
        return outs, p / p.sum(axis=1, keepdims=True)

    def step(self, z: np.ndarray, labels: np.ndarray, rate: float, momentum: float) -> tuple[np.ndarray, np.ndarray]:
        """One step of descent; returns the gradient at the first layer's products, and the probabilities before the step."""
        outs, p = self.forward(z)
        back = p.copy()
        back[np.arange(len(labels)), labels] -= 1
        back /= len(labels)
        for k in range(len(self.weights) - 1, -1, -1):
            down = (back @ self.weights[k].T) * (outs[k] > 0)
            self.weight_speed[k] = momentum * self.weight_speed[k] - rate * (outs[k].T @ back)
            self.bias_speed[k + 1] = momentum * self.bias_speed[k + 1] - rate * back.sum(axis=0)
            self.weights[k] = self.weights[k] + self.weight_speed[k]
            self.biases[k + 1] = self.biases[k + 1] + self.bias_speed[k + 1]
            back = down
        self.bias_speed[0] = momentum * self.bias_speed[0] - rate * back.sum(axis=0)
        self.biases[0] = self.biases[0] + self.bias_speed[0]
        return back, p

    def copy(self) -> "Head":
        return Head(*[[x.copy() for x in part] for part in (self.weights, self.biases, self.weight_speed, self.bias_speed)])


@dataclass
class Network:
    """A trained network: the first layer is the table at ``path``."""

    plan: Plan
    path: str
    head: Head
    history: list[tuple] = field(default_factory=list)

    def state(self, spark) -> DataFrame:
        return spark.read.schema(_STATE).parquet(self.path)


def feature_blocks(rows: DataFrame, plan: Plan, label_col: str = "label", features_col: str = "features", row_col: str = "row") -> DataFrame:
    """``(row, label, block, x)``: the features of numbered rows cut into blocks,
    stored by block and row so that a window reads its own rows only.

    A row of another width than the plan's fails.
    """
    size = F.size(F.col(features_col))
    fits = F.when(size == plan.n_features, F.col(features_col)).otherwise(F.raise_error(F.concat(
        F.lit(f"a row has not {plan.n_features} features but "), size.cast("string"))))
    cut = F.transform(F.sequence(F.lit(0), F.lit(plan.n_blocks - 1)), lambda b: F.slice("__x", b * plan.block + 1, F.lit(plan.block)))
    blocks = (rows.select(F.col(row_col).cast("long").alias("row"), F.col(label_col).cast("int").alias("label"), fits.cast("array<double>").alias("__x"))
              .select("row", "label", F.posexplode(cut).alias("block", "x")))
    tasks = max(plan.n_blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(blocks.repartitionByRange(tasks, "block", "row").sortWithinPartitions("block", "row"), "network-rows")


def _matrix(values, width: int) -> np.ndarray:
    return np.stack(values.to_list()) if len(values) else np.empty((0, width))


def _window(blocks: DataFrame, first: int, size: int, n_rows: int) -> DataFrame:
    """The rows of a window, which may go over the end of the file, with their place in it."""
    row, end = F.col("row"), first + size
    inside = (row >= first) & (row < end) if end <= n_rows else (row >= first) | (row < end - n_rows)
    return blocks.where(inside).withColumn("place", F.pmod(row - first, F.lit(n_rows)))


def _products(window: DataFrame, state: DataFrame, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the window's rows, their products with the first layer's
    weights and velocities, and with each other: partial products of each
    feature block, summed by Spark in row chunks."""
    def partial(rows: pd.DataFrame, layer: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"chunk": [], "data": []})
        rows = rows.sort_values("place")
        x = _matrix(rows["x"], 0)
        w, v = (np.frombuffer(layer[c].iloc[0]).reshape(x.shape[1], -1) for c in ("w", "v"))
        out = np.concatenate([x @ w, x @ v, x @ x.T], axis=1)
        return pd.DataFrame({"chunk": np.arange(0, len(out), CHUNK), "data": [out[i:i + CHUNK].tobytes() for i in range(0, len(out), CHUNK)]})

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d) for d in parts["data"])
        return pd.DataFrame({"chunk": parts["chunk"].iloc[:1], "data": [total.tobytes()]})

    schema = "chunk long, data binary"
    parts = window.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(partial, schema)
    found = parts.groupBy("chunk").applyInPandas(added, schema).collect()  # bounded: one window of rows
    labels = [r["label"] for r in window.where("block = 0").orderBy("place").select("label").collect()]  # bounded: one window of rows
    whole = np.concatenate([np.frombuffer(r["data"]) for r in sorted(found, key=lambda r: r["chunk"])]).reshape(len(labels), -1)
    h = plan.hidden[0]
    return np.array(labels), whole[:, :h], whole[:, h:2 * h], whole[:, 2 * h:]


@dataclass
class _Moves:
    """The first layer after some steps of a window: W = W0 + ``a`` V0 - X' ``p``, V = ``m`` V0 - X' ``q``."""

    a: float
    m: float
    p: np.ndarray
    q: np.ndarray


def _moved(window: DataFrame, state: DataFrame, moves: _Moves) -> DataFrame:
    """The state table after a window, each block by itself."""
    def move(rows: pd.DataFrame, layer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        w, v = _after(_matrix(rows["x"], 0), layer, moves)
        return pd.DataFrame({"block": layer["block"].iloc[:1], "w": [w.tobytes()], "v": [v.tobytes()]})

    return window.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(move, _STATE)


def _after(x: np.ndarray, layer, moves: _Moves) -> tuple[np.ndarray, np.ndarray]:
    w, v = (np.frombuffer(layer[c].iloc[0]).reshape(x.shape[1], -1) for c in ("w", "v"))
    return w + moves.a * v - x.T @ moves.p, moves.m * v - x.T @ moves.q


def fit(blocks: DataFrame, n_rows: int, plan: Plan, valid: DataFrame | None = None, window: int = WINDOW) -> Network:
    """Train on ``n_rows`` numbered rows cut by `feature_blocks`.

    ``history`` has one row per epoch: mean loss and accuracy of its batches as
    they were met, and loss and accuracy of all rows of ``valid`` (blocks of
    another table) after it, None without one.  The loss is the cross entropy.
    A window has at most ``window`` rows and ends with an epoch at the latest,
    but takes several epochs where the whole file has no more rows than that.
    Where the plan has one block, rows stream past it instead (`_stream`).
    """
    if n_rows < 1:
        raise ValueError("a network needs at least one row to train on")
    spark = blocks.sparkSession
    steps = steps_per_epoch(n_rows, plan.batch)
    net = Network(plan, derived_path(spark, "network-layer"), plan.head())
    hidden = plan.hidden[0]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column("id").to_pylist():
                w = plan.first_weights(k)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([w.tobytes()], pa.binary()),
                                                  pa.array([np.zeros_like(w).tobytes()], pa.binary())], ["block", "w", "v"])

    spark.range(0, plan.n_blocks, 1, plan.n_blocks).mapInArrow(first, _STATE).write.parquet(net.path)
    if plan.n_blocks == 1:
        at_once = max(1, STREAM // (steps * plan.batch))
        for epoch in range(0, plan.epochs, at_once):
            _stream(net, blocks, n_rows, epoch, min(plan.epochs, epoch + at_once), valid)
        return net
    # Steps of a window: whole epochs where all rows fit in, else what fits in and stays in its epoch.
    whole = n_rows <= max(window, plan.batch)
    at, total = 0, plan.epochs * steps
    losses, hits = [], []
    while at < total:
        until = total if whole else min(at + max(1, window // plan.batch), (at // steps + 1) * steps)
        begin = at * plan.batch % n_rows
        rows = min(n_rows, (until - at) * plan.batch)
        part, state = _window(blocks, begin, rows, n_rows), net.state(spark)
        labels, z0, y0, gram = _products(part, state, plan)
        moves = _Moves(0.0, 1.0, np.zeros((rows, hidden)), np.zeros((rows, hidden)))
        ends = []
        for step in range(at, until):
            place = (step * plan.batch - begin + np.arange(plan.batch)) % n_rows
            z = z0[place] + moves.a * y0[place] - gram[place] @ moves.p
            rate = plan.rate_at(step)
            back, p = net.head.step(z, labels[place], rate, plan.momentum)
            moves.m *= plan.momentum
            moves.a += moves.m
            moves.q *= plan.momentum
            np.add.at(moves.q, place, rate * back)
            moves.p += moves.q
            losses.append(-np.log(np.maximum(p[np.arange(plan.batch), labels[place]], 1e-300)).mean())
            hits.append((p.argmax(axis=1) == labels[place]).mean())
            if (step + 1) % steps == 0:
                seen = _Moves(moves.a, moves.m, moves.p.copy(), moves.q) if valid is not None else None
                ends.append((step // steps, float(np.mean(losses)), float(np.mean(hits)), seen, net.head.copy()))
                losses, hits = [], []
        checked = _validate(valid, part, state, ends, plan) if valid is not None and ends else {}
        net.history += [(epoch, loss, hit, *checked.get(epoch, (None, None))) for epoch, loss, hit, _, _ in ends]
        path = derived_path(spark, "network-layer")
        _moved(part, state, moves).write.parquet(path)
        discard(spark, net.path)
        net.path, at = path, until
    return net


def _stream(net: Network, blocks: DataFrame, n_rows: int, epoch: int, until: int, valid: DataFrame | None) -> None:
    """Whole epochs of a network of one block in one job: descent is a chain of
    steps, so one task holds the layer and the rows stream past it in the order
    of their use.  Its memory is that of the layer and one Arrow batch."""
    spark, plan, head = blocks.sparkSession, net.plan, net.head
    steps = steps_per_epoch(n_rows, plan.batch)
    begin, end = epoch * steps * plan.batch, until * steps * plan.batch
    # Uses of row r are the positions r, r + n_rows, ... of the endless file.
    use = F.lit(begin) + F.pmod(F.col("row") - begin, F.lit(n_rows))
    uses = F.when(use < end, F.sequence(use, F.lit(end - 1).cast("long"), F.lit(n_rows).cast("long")))
    every = (net.state(spark).select(F.lit(-1).cast("long").alias("at"), "w", "v")
             .unionByName(blocks.withColumn("at", F.explode(uses)).select("at", "label", "x"), allowMissingColumns=True))
    dealt = every.repartition(1).sortWithinPartitions("at").select("at", "label", "x", "w", "v")

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, losses, hits, w, v = epoch * steps, [], [], None, None
        rest = np.empty((0, plan.n_features)), np.empty(0, np.int64)
        for b in batches:
            if w is None and len(b):  # the layer comes before the rows
                w, v = (np.frombuffer(b.column(c)[0].as_py()).reshape(plan.n_features, -1).copy() for c in ("w", "v"))
                b = b.slice(1)
            if not len(b):
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
            labels = b.column("label").to_numpy(zero_copy_only=False)
            if len(rest[1]):
                x, labels = np.concatenate([rest[0], x]), np.concatenate([rest[1], labels])
            whole = len(x) // plan.batch * plan.batch
            for lo in range(0, whole, plan.batch):
                some, y, rate = x[lo:lo + plan.batch], labels[lo:lo + plan.batch], plan.rate_at(step)
                back, p = head.step(some @ w, y, rate, plan.momentum)
                v *= plan.momentum
                v -= rate * (some.T @ back)
                w += v
                losses.append(-np.log(np.maximum(p[np.arange(plan.batch), y], 1e-300)).mean())
                hits.append((p.argmax(axis=1) == y).mean())
                step += 1
                if step % steps == 0:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([step // steps - 1], pa.int32()), pa.array([float(np.mean(losses))]), pa.array([float(np.mean(hits))]),
                         pa.array([pickle.dumps(head)], pa.binary()), pa.array([0], pa.int32()), pa.array([w.tobytes()], pa.binary()),
                         pa.array([v.tobytes() if step == until * steps else None], pa.binary())], ["turn", "loss", "hits", "head", "block", "w", "v"])
                    losses, hits = [], []
            rest = x[whole:], labels[whole:]

    path = derived_path(spark, "network-epochs")
    dealt.mapInArrow(descend, "turn int, loss double, hits double, head binary, " + _STATE).write.parquet(path)
    done = spark.read.parquet(path)
    ends = [(r["turn"], r["loss"], r["hits"], pickle.loads(r["head"]))
            for r in done.select("turn", "loss", "hits", "head").orderBy("turn").collect()]  # bounded: one small row an epoch
    if [e[0] for e in ends] != [*range(epoch, until)]:
        raise ValueError(f"the rows are not numbered from 0 to {n_rows - 1}")
    checked = _measured(valid, done.select("block", "turn", "w"), plan, {turn: h for turn, _, _, h in ends}) if valid is not None else {}
    net.history += [(turn, loss, hit, *checked.get(turn, (None, None))) for turn, loss, hit, _ in ends]
    after = derived_path(spark, "network-layer")
    done.where(F.col("turn") == until - 1).select("block", "w", "v").write.parquet(after)
    discard(spark, net.path)
    discard(spark, path)
    net.path, net.head = after, ends[-1][3]


def _sums(rows: DataFrame, layers: DataFrame, plan: Plan, heads: dict[int, Head], out: str, finish) -> DataFrame:
    """``finish`` of each chunk of rows and each layer version (``turn``): their
    products with the version's weights, summed over the feature blocks.  Rows
    stream past the weights of their block, so any number of them is fine; few
    blocks are dealt to several tasks each, by chunk.  With one block there is
    nothing to sum, and rows are finished where they are."""
    hidden = plan.hidden[0]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // plan.n_blocks
    parts = max(1, min(tasks, COPIES // (len(heads) * min(plan.block, plan.n_features) * hidden * 8)))
    here = F.col("block") * parts
    every = (layers.select(F.explode(F.sequence(here, here + (parts - 1))).alias("deal"), "turn", F.lit(0).alias("kind"), "w").unionByName(
        rows.select((here + F.pmod(F.floor(F.col("row") / CHUNK), F.lit(parts))).cast("int").alias("deal"), F.lit(1).alias("kind"), "row", "label", "x"),
        allowMissingColumns=True))
    dealt = every.repartition(plan.n_blocks * parts, "deal").sortWithinPartitions("deal", "kind", "turn", "row").select("deal", "kind", "turn", "row", "label", "x", "w")
    ready = to_arrow_schema(T.StructType.fromDDL(out)) if plan.n_blocks == 1 else None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal, weights = None, {}
        for b in batches:
            kinds, of = b.column("kind").to_numpy(), b.column("deal").to_numpy()
            for k in np.unique(of):  # ascending, as the rows
                if k != deal:
                    deal, weights = k, {}
                mine = of == k
                for i in np.flatnonzero(mine & (kinds == 0)).tolist():
                    weights[b.column("turn")[i].as_py()] = np.frombuffer(b.column("w")[i].as_py()).reshape(-1, hidden)
                own = np.flatnonzero(mine & (kinds == 1))
                for lo in range(0, len(own), CHUNK):
                    some = pa.array(own[lo:lo + CHUNK])
                    x = b.column("x").take(some)
                    x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                    rid, label = b.column("row").take(some).to_numpy(), b.column("label").take(some).to_numpy(zero_copy_only=False)
                    for turn, w in weights.items():
                        z = x @ w
                        if ready:
                            done = finish(turn, rid.tolist(), label.astype(np.int64), heads[turn].forward(z)[1])
                            yield pa.RecordBatch.from_pandas(done, ready, preserve_index=False)
                            continue
                        chunk = rid // CHUNK
                        for c in np.unique(chunk):
                            at = chunk == c
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([int(c)]), pa.array([turn], pa.int32()), pa.array([rid[at].tobytes()], pa.binary()),
                                 pa.array([label[at].astype(np.int64).tobytes()], pa.binary()), pa.array([z[at].tobytes()], pa.binary())],
                                ["chunk", "turn", "rows", "labels", "z"])

    if ready:
        return dealt.mapInArrow(partial, out)

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        head = heads[int(parts["turn"].iloc[0])]
        total: dict = {}
        labels: dict = {}
        for rid, label, z in zip(parts["rows"], parts["labels"], parts["z"]):
            rid = np.frombuffer(rid, np.int64)
            place = {r: i for i, r in enumerate(rid.tolist())}
            z = np.frombuffer(z).reshape(len(rid), hidden)
            for r, i in place.items():
                total[r] = total[r] + z[i] if r in total else z[i]
            labels.update(zip(rid.tolist(), np.frombuffer(label, np.int64).tolist()))
        ids = sorted(total)
        return finish(int(parts["turn"].iloc[0]), ids, np.array([labels[r] for r in ids]), head.forward(np.stack([total[r] for r in ids]))[1])

    sent = dealt.mapInArrow(partial, "chunk long, turn int, rows binary, labels binary, z binary")
    return sent.groupBy("chunk", "turn").applyInPandas(whole, out)


def _validate(valid: DataFrame, window: DataFrame, state: DataFrame, ends: list, plan: Plan) -> dict[int, tuple[float, float]]:
    """Loss and accuracy of all validation rows after each of the window's epochs, in one job."""
    moves = {epoch: seen for epoch, _, _, seen, _ in ends}
    heads = {epoch: head for epoch, _, _, _, head in ends}

    def versions(rows: pd.DataFrame, layer: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(rows.sort_values("place")["x"], 0)
        return pd.DataFrame([(int(layer["block"].iloc[0]), epoch, _after(x, layer, m)[0].tobytes()) for epoch, m in moves.items()],
                            columns=["block", "turn", "w"])

    layers = window.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(versions, "block int, turn int, w binary")
    return _measured(valid, layers, plan, heads)


def _measured(valid: DataFrame, layers: DataFrame, plan: Plan, heads: dict[int, Head]) -> dict[int, tuple[float, float]]:
    """Loss and accuracy of all validation rows for each version of the network."""
    def measure(turn: int, ids: list, labels: np.ndarray, p: np.ndarray) -> pd.DataFrame:
        known = p[np.arange(len(labels)), labels]
        return pd.DataFrame({"turn": [turn], "n": [len(ids)], "loss": [float(-np.log(np.maximum(known, 1e-300)).sum())],
                             "hits": [int((p.argmax(axis=1) == labels).sum())]})

    measured = _sums(valid, layers, plan, heads, "turn int, n long, loss double, hits long", measure)
    got = measured.groupBy("turn").agg(F.sum("loss") / F.sum("n"), F.sum("hits") / F.sum("n")).collect()  # bounded: one row an epoch
    return {r[0]: (r[1], r[2]) for r in got}


def predict(blocks: DataFrame, net: Network) -> DataFrame:
    """``(row, label, probability, prediction)`` of every row cut by `feature_blocks`."""
    def scored(turn: int, ids: list, labels: np.ndarray, p: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"row": ids, "label": labels.astype(float), "probability": list(p), "prediction": p.argmax(axis=1).astype(float)})

    layers = net.state(blocks.sparkSession).select("block", F.lit(0).alias("turn"), "w")
    return _sums(blocks, layers, net.plan, {0: net.head}, "row long, label double, probability array<double>, prediction double", scored)


def history_table(spark, net: Network) -> DataFrame:
    """``(epoch, loss, accuracy, val_loss, val_accuracy)``, one row per epoch."""
    return spark.createDataFrame(net.history, "epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
