"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its subwords: every run of one to
four bytes inside a word (words are case-folded A-Z and framed by a space),
hashed to ``buckets`` rows.  The embeddings and a linear softmax on top are
trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows, as many of every language: tasks count the subwords of the
sampled texts (whole texts, every subword), and one task learns from these
counts.  A temperature fitted on a part of the sample that the descent never
saw calibrates the scores.  The rejection threshold is the score that all but
``reject_share`` of that part's right answers reach, each text of it both by
itself and with passages of another one.

The trained model is a table of ``buckets x languages`` numbers (embeddings
times softmax weights), which is all that scoring needs; its size is fixed by
the parameters, so it travels to the tasks inside the function.

Half of the training steps add subwords of another training text, fewer than
the text's own, and keep the label: a text that quotes a passage of another
language is still in its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import text

LENGTHS = (1, 2, 3, 4)
UNDETERMINED = "und"
#: Largest part of another text that a training text may quote.
QUOTED = 0.8 / 1.8
#: More languages than this are refused: the model's size follows them.
LANGUAGES = 1000

# Bytes that are part of a word: ASCII letters and all bytes of other characters.
_LETTERS = text.byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_FOLDED = np.where(_LETTERS, text.FOLD, np.uint8(0x20)).astype(np.uint64)
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)


def subwords(buf: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per run length: the bucket of the run at each byte, and whether the run
    lies within a word (one framing space on either side counts as in)."""
    folded = _FOLDED[buf]
    blank = folded == 0x20
    # Two blanks inside a run mean that it leaves its word, unless both frame it.
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    run = np.zeros(len(buf), dtype=np.uint64)
    inner = np.zeros(len(buf), dtype=bool)
    for i, n in enumerate(LENGTHS):
        size = len(buf) - n + 1
        if size <= 0:
            return
        run = (run[:size] << np.uint64(8)) | folded[n - 1:]
        if n >= 3:
            inner = inner[:size] | blank[n - 2:len(buf) - 1]
        inside = ~inner[:size] & ~(blank[:size] & blank[n - 1:])
        yield ((run * _SALTS[i]) >> shift).astype(np.int64), inside


@dataclass
class Model:
    """A trained model: what scoring needs, and how it was calibrated."""

    languages: list[str]
    table: np.ndarray  # (buckets, languages), float32
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Calibrated probabilities, one row per text; a text without a subword gets the bias alone."""
        out = np.empty((len(texts), len(self.languages)))
        for lo, hi in text.slices(texts, text.PIECE):
            out[lo:hi] = self._logits(texts[lo:hi])
        return _softmax(out / self.temperature)

    def _logits(self, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        if len(texts) == 1 and len(texts[0]) > text.PIECE:
            # One long text: pieces cut at a space where there is one.
            for piece in _pieces(texts[0]):
                s, n = self._sums(*text.joined([piece]))
                total, count = total + s, count + n
        else:
            total, count = self._sums(*text.joined(texts))
        return total / np.maximum(count, 1)[:, None] + self.bias

    def _sums(self, buf: np.ndarray, begins: np.ndarray):
        total = np.zeros((len(begins) - 1, len(self.languages)))
        count = np.zeros(len(begins) - 1)
        for bucket, inside in subwords(buf, len(self.table)):
            weight = self.table[bucket]
            weight[~inside] = 0
            at = np.minimum(begins[:-1], len(bucket) - 1)
            total += np.add.reduceat(weight, at, axis=0, dtype=np.float64)
            count += np.add.reduceat(inside, at, dtype=np.int64)
        return total, count


def _pieces(body: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(body):
        end = body.find(b" ", at + text.PIECE)
        end = len(body) if end < 0 or end - at > 2 * text.PIECE else end
        end = min(end, at + 2 * text.PIECE)
        yield body[at:end]
        at = end


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bag(body: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct subword buckets of a whole text, and the share of each in all its subwords."""
    count = np.zeros(buckets, np.int64)
    for piece in [body] if len(body) <= text.PIECE else _pieces(body):
        for at, inside in subwords(np.frombuffer(piece + b" ", dtype=np.uint8), buckets):
            count += np.bincount(at[inside], minlength=buckets)
    at = np.flatnonzero(count)
    return at.astype(np.uint32), (count[at] / max(1, count.sum())).astype(np.float32)


Bag = tuple[np.ndarray, np.ndarray]


def _mixed(own: Bag, other: Bag, part: float) -> Bag:
    """A text that quotes another one: ``part`` of its subwords are the other's."""
    return np.append(own[0], other[0]), np.append((1 - part) * own[1], part * other[1])


def train(texts: list[bytes], labels: list[str], buckets: int = 1 << 15, **options) -> Model:
    """``learn`` from whole texts at hand."""
    return learn([bag(t, buckets) for t in texts], labels, buckets, **options)


def learn(bags: list[Bag], labels: list[str], buckets: int = 1 << 15, dim: int = 16, epochs: int = 4, rate: float = 4.0,
          reject_share: float = 0.0005, seed: int = 7) -> Model:
    """Fit embeddings, softmax, temperature and threshold on labelled texts' subwords.

    Every fifth text (in the given order) is kept for calibration.  Without
    labelled texts the model knows no language and rejects everything.
    """
    languages = sorted(set(labels))
    n = max(1, len(languages))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    weight, bias = np.zeros((dim, n), np.float32), np.zeros(n, np.float32)
    if not languages:
        return Model([UNDETERMINED], np.zeros((buckets, 1), np.float32), bias, 1.0, 2.0)
    y = np.searchsorted(languages, labels)
    use = [i for i in range(len(bags)) if len(bags[i][0])]
    held = [i for k, i in enumerate(use) if k % 5 == 4]
    fit = [i for k, i in enumerate(use) if k % 5 != 4]
    # Classes weigh alike, so a language with few texts is learned as well as the others.
    share = np.bincount(y[fit], minlength=n).astype(float) if fit else np.ones(n)
    balance = np.minimum(10.0, len(fit) / np.maximum(1, share) / n)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit):
            parts, back = [bags[i]], 1.0
            if rng.random() < 0.5:
                # A text that quotes another one (any language) keeps its own label.
                quoted = rng.uniform(0, QUOTED)
                parts, back = [bags[i], bags[fit[rng.integers(len(fit))]]], 1 - quoted
            mean = sum(f * (s @ embed[at]) for f, (at, s) in zip((back, 1 - back), parts))
            p = mean @ weight + bias
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= balance[y[i]]
            down = step * (weight @ p)
            weight -= (step * 0.1) * np.outer(mean, p)
            bias -= (step * 0.002) * p
            for f, (at, s) in zip((back, 1 - back), parts):
                embed[at] -= f * s[:, None] * down
    model = Model(languages, embed @ weight, bias, 1.0, 0.0)
    if held:
        def logits(some: list[Bag]) -> np.ndarray:
            return np.stack([s @ model.table[at] for at, s in some]) + bias

        truth, alone = y[held], logits([bags[i] for i in held])
        candidates = np.geomspace(0.05, 20, 60)
        loss = [-np.log(np.maximum(_softmax(alone / t)[np.arange(len(held)), truth], 1e-12)).mean() for t in candidates]
        model.temperature = float(candidates[int(np.argmin(loss))])
        # Texts torn between two languages are part of what must not be rejected.
        torn = logits([_mixed(bags[i], bags[held[rng.integers(len(held))]], rng.uniform(0, QUOTED)) for i in held])
        p, truth = _softmax(np.concatenate([alone, torn]) / model.temperature), np.append(truth, truth)
        top = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
        model.threshold = float(top[int(reject_share * len(top))]) if len(top) else 0.0
    return model


def sample(labelled: DataFrame, text_col: str, label_col: str, order: Column, limit: int, buckets: int) -> DataFrame:
    """``(label, place, at, share)``: the subwords of at most ``limit`` labelled
    texts, the same in every run: as many of each language, those first by
    ``order`` (a hash), and at least eight of a rare one."""
    rows = labelled.select(F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{text_col}`").cast("string").alias("text"), order.alias("place"))
    rows = rows.where(F.col("label").isNotNull() & has_letter(F.col("text")))
    known = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(LANGUAGES + 1).collect()}  # bounded: one row a language
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    each = max(8, limit // max(1, len(known)))
    size = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])[F.col("label")] if known else F.lit(1)
    # Rows outside a share of about twice the number wanted are left out before any are ranked.
    near = rows.where(F.pmod(F.col("place"), size.cast("long")) < 2 * each)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("place", F.xxhash64("text"))))
    chosen = ranked.where(F.col("rank") <= each).select("label", "place", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text.pieces(batches, 256):
            found = [bag(t, buckets) for t in text.utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("place"), *[pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1)]],
                                             ["label", "place", "at", "share"])

    return chosen.mapInArrow(count, "label string, place long, at binary, share binary")


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", order: Column | None = None,
        limit: int = 4000, buckets: int = 1 << 15, **options) -> Model:
    """Train on a bounded sample of ``docs``: rows with a label and a letter,
    ``limit`` of them, shared evenly among the languages (see `sample`;
    ``order`` is by default a hash of the text).  Their texts are used whole.

    One task learns from the sample; the driver gets the model, whose size is
    ``buckets`` times the languages.
    """
    order = F.xxhash64(F.col(f"`{text_col}`")) if order is None else order

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, bags = [], []
        for b in batches:
            labels += b.column("label").to_pylist()
            bags += [(np.frombuffer(at, np.uint32), np.frombuffer(s, np.float32))
                     for at, s in zip(b.column("at").to_pylist(), b.column("share").to_pylist())]
        m = learn(bags, labels, buckets, **options)
        yield pa.RecordBatch.from_arrays([pa.array([m.languages]), pa.array([m.table.astype(np.float32).tobytes()], pa.binary()),
                                          pa.array([m.bias.tolist()], pa.list_(pa.float64())), pa.array([m.temperature]), pa.array([m.threshold])],
                                         ["languages", "data", "bias", "temperature", "threshold"])

    rows = sample(docs, text_col, label_col, order, limit, buckets).repartition(1).sortWithinPartitions("place", "label", "at")
    found = rows.mapInArrow(teach, "languages array<string>, data binary, bias array<double>, temperature double, threshold double").collect()  # bounded: one model
    if not found:
        return learn([], [], buckets, **options)
    r = found[0]
    table = np.frombuffer(r["data"], np.float32).reshape(buckets, -1)
    return Model(list(r["languages"]), table, np.array(r["bias"], np.float32), r["temperature"], r["threshold"])


def has_letter(t: Column) -> Column:
    return F.coalesce(t.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (all columns of ``docs``), ``lang_pred``, ``score``, ``rejected``.

    Whole texts are read.  A null text, or one without a letter, is ``und``
    with score 0 and rejected.  Other texts get the likeliest language (ties
    go to the first by name) and its calibrated probability, and are rejected
    below the model's threshold.  Nothing but the text column is looked at;
    repeated rows give repeated results and an empty table an empty one.
    """
    t = F.col(f"`{text_col}`")
    # A text column travels once, inside its row.
    inside = docs.columns.index(text_col) if docs.schema[text_col].dataType == T.StringType() else None
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), has_letter(t).alias("known"),
                       *([] if inside is not None else [t.cast("string").alias("text")]))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for b in text.pieces(batches):
            known = b.column("known").to_numpy(zero_copy_only=False)
            texts = text.utf8(b.column("text") if inside is None else b.column("row").field(inside))
            p = model.scores([t if k else b"" for t, k in zip(texts, known)])
            best = np.where(known, p.argmax(axis=1), len(names) - 1)
            score = np.where(known, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(names[best], pa.string()), pa.array(score), pa.array(~known | (score < model.threshold))],
                ["row", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(predict, schema)


def fold(id_col: Column, folds: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text modulo ``folds``; null ids have none."""
    return F.crc32(id_col.cast("string")) % folds
