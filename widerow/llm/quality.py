"""A quality classifier on statistics of documents.

The statistics (lengths, shares of kinds of characters, repetition of words, word triples
and lines) are scaled and mapped to random Fourier features, whose inner products
approximate a Gaussian kernel. Ridge weights solve the normal equations, which partitions
of the training rows add up. An isotonic curve, fitted on training rows kept out of the
equations, turns the result into the share of good documents.

Training reads about ``MAX_ROWS`` labelled rows, chosen by a hash; scoring is one pass over
the documents without a shuffle. Without any training row every score is 1: nothing speaks
against a text. Null and empty texts have all statistics 0 and are scored like others.
Equal texts get equal scores.
Columns of the input named like added ones are replaced.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, isotonic, labelled_sample, stored

MAX_ROWS = 20_000
FEATURES = 384
WIDTH = 2.0  # of the kernel, in standard deviations
RIDGE = 1e-3
SLOTS = 16
CALIBRATION = 4  # every fourth training row draws the curve
SEED = 3

_UPPER = np.arange(0x41, 0x5B)
_LOWER = np.r_[0x61:0x7B, 0x80:0x100]
_DIGIT = np.arange(0x30, 0x3A)
_SPACE = np.array([0x20, 0x09, 0x0A, 0x0D])
_STOPS = np.frombuffer(b".,;:'\"-", np.uint8)


def statistics(raw: bytes) -> list[float]:
    """Numbers that describe a text, each between 0 and about 1."""
    size = len(raw)
    if not raw.split():
        return [0.0] * 13
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    digits, stops = counts[_DIGIT].sum(), counts[_STOPS].sum()
    symbols = size - upper - lower - digits - stops - counts[_SPACE].sum()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    distinct = len(set(words))
    triples = len(set(zip(words, words[1:], words[2:])))
    return [
        np.log(size) / 12,
        np.log(n) / 10,
        min(size / n / 20, 2.0),
        np.sqrt(upper / (upper + lower + 1)),
        np.sqrt(digits / size),
        np.sqrt(stops / size),
        np.sqrt(max(symbols, 0) / size),
        np.sqrt(counts[0x7C] / size),
        distinct / n,
        np.log(distinct) / max(np.log(n), 1e-9) if n > 1 else 1.0,
        triples / max(n - 2, 1),
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    rows = [statistics(raw or b"") for raw in texts.cast(pa.binary()).to_pylist()]
    return pa.array(rows, pa.list_(pa.float64()))


class Model:
    """What scoring needs; a few arrays of fixed size."""

    def __init__(self, mean, scale, weights, at, to):
        self.mean, self.scale = mean, scale
        rng = np.random.default_rng(SEED)
        self.directions = rng.normal(0, 1 / WIDTH, (len(mean), FEATURES))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights, self.at, self.to = weights, at, to

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        scaled = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.at, self.to), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The normal equations, added up by partition, then by slot, then here."""
    width = FEATURES + 1

    def by_partition(batches):
        total = np.zeros((width, width + 1))
        slot = TaskContext.get().partitionId() % SLOTS
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch["stats"]))
                y = batch["_label"].to_numpy().astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_pydict({"slot": [slot], "sums": [total.tobytes()]})

    def by_slot(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in group["sums"])
        return pa.table({"slot": group["slot"][:1], "sums": [total.tobytes()]})

    schema = "slot long, sums binary"
    sums = train.mapInArrow(by_partition, schema).groupBy("slot")
    rows = sums.applyInArrow(by_slot, schema).collect()  # SLOTS rows
    total = sum(np.frombuffer(r["sums"]) for r in rows).reshape(width, width + 1)
    return total[:, :width], total[:, width]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    kept: Column,
    text: str = "text",
    key: str = "doc_id",
    max_rows: int = MAX_ROWS,
) -> Model | None:
    """The model of labels that are ``kept``; None without any."""
    sample = labelled_sample(docs.select(key, text), labels, label, kept, max_rows, key)
    fold = F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(CALIBRATION)) == 0
    train = stored(
        sample.select(
            "_label", fold.alias("curve"), _statistics(text).alias("stats")
        ).repartition(SLOTS)
    )
    first = train.first()
    if first is None:
        return None
    each = [F.col("stats")[i] for i in range(len(first["stats"]))]
    moments = train.agg(*(f(c) for c in each for f in (F.avg, F.stddev_pop))).first()
    mean, scale = np.array(moments[0::2]), np.array(moments[1::2])
    model = Model(mean, np.maximum(scale, 1e-3), None, None, None)
    fitted = train.filter(~F.col("curve"))
    products, targets = _sums(fitted, model)
    n = max(products[-1, -1], 1.0)
    penalty = RIDGE * n * np.eye(FEATURES + 1) / FEATURES
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(products + penalty, targets)

    @F.arrow_udf("double")
    def raw(stats: pa.Array) -> pa.Array:
        return pa.array(np.round(np.clip(model.raw(_matrix(stats)), -1, 2), 3))

    bins = (
        train.withColumn("raw", raw("stats"))
        .groupBy("raw")
        .agg(
            F.sum(F.col("curve").cast("int")).alias("n"),
            F.sum(F.when(F.col("curve"), F.col("_label")).otherwise(0)).alias("y"),
            F.count("*").alias("all"),
            F.sum("_label").alias("y_all"),
        )
        .collect()
    )  # 3,001 rows at most
    points = [(r["raw"], r["n"], r["y"]) for r in bins if r["n"]]
    points = points or [(r["raw"], r["all"], r["y_all"]) for r in bins]
    model.at, model.to = isotonic(points)
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents with ``score``, the calibrated share of good ones."""
    out = fresh(docs, "score")
    if model is None:
        return out.withColumn("score", F.lit(1.0))

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        rows = [statistics(raw or b"") for raw in texts.cast(pa.binary()).to_pylist()]
        return pa.array(model.score(np.array(rows)) if rows else [], pa.float64())

    return out.withColumn("score", scores.asNondeterministic()(text))
