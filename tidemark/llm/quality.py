"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

A text becomes a short vector of statistics (lengths, shares of byte classes,
word shapes, repetition). Standardised by the training sample, it is mapped to
cosines of random projections, whose inner products approximate a Gaussian
kernel. Each partition of the sample sums its own normal equations, the sums
are added and solved for the ridge weights; a part of the sample that the fit
has not seen calibrates the raw scores by pool-adjacent-violators, read between
block centres by linear interpolation so that order is kept.

Labels come from the rows outside the held-out third, ``train_rows`` of them at
most. No statistic is an id, a language, a source or a label.

Defined results: null and empty texts are scored like any text (all statistics
0); very long texts are measured whole; repeated rows are scored alike; labels of
one id that differ count as 1; raw scores that tie are calibrated alike; without
both kinds of label every score is the share of label 1 (a half without labels);
an empty table gives an empty result; only the named columns are read, whatever
the others' names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labels import held_out, training_sample
from tidemark.llm.wordhash import buffers, pieces, word_hashes
from tidemark.session import modest_batches

#: Byte classes whose shares are statistics.
CLASSES = ("space", "break", "lower", "upper", "digit", "stop", "comma", "shout", "bar", "mark", "high", "other")
PARTS = 16


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in {"space": b" \t\r\x0b\x0c", "break": b"\n", "stop": b".", "comma": b",;:'\"()-", "shout": b"!?", "bar": b"|/\\<>{}[]", "mark": b"#$%&*@^~_+="}.items():
        table[list(chars)] = CLASSES.index(name)
    table[97:123], table[65:91], table[48:58], table[128:] = (CLASSES.index(x) for x in ("lower", "upper", "digit", "high"))
    return table


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of document statistics for each text."""
    data, offsets = buffers(texts)
    n, kinds = len(offsets) - 1, len(CLASSES)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    share = np.bincount(owner * kinds + _class_table()[data], minlength=n * kinds).reshape(n, kinds).astype(float)
    size = np.diff(offsets).astype(float)
    words, first, starts = word_hashes(texts, lower=False)
    lines = share[:, CLASSES.index("break")] + 1
    count = np.diff(first).astype(float)
    distinct, twice, steps, capital = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    heads = _class_table()[data[starts]] == CLASSES.index("upper") if len(starts) else np.zeros(0, bool)
    for i, (a, b) in enumerate(pairwise(first)):
        if b > a:
            w = words[a:b]
            distinct[i] = len(np.unique(w))
            twice[i] = np.count_nonzero(w[1:] == w[:-1])
            steps[i] = len(np.unique(w[1:] * np.uint64(3) + w[:-1])) if b - a > 1 else 1
            capital[i] = np.count_nonzero(heads[a:b])
    some, long = np.maximum(count, 1), np.maximum(size, 1)
    solid = size - share[:, CLASSES.index("space")] - share[:, CLASSES.index("break")]
    columns = [np.log1p(size), np.log1p(count), np.log1p(lines - 1), solid / some, np.log1p(count / lines), distinct / np.sqrt(some), distinct / some, twice / some, steps / some, capital / some, share[:, CLASSES.index("stop")] / some, share[:, CLASSES.index("comma")] / some]
    return np.column_stack([*columns, share / long[:, None]])


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their levels, both rising."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of raw, sum of y, rows
    for r, t in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([r, t, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    # Half a row of either label keeps the ends off 0 and 1.
    return np.array([s / n for s, _, n in blocks]), np.array([(t + 0.5) / (n + 1) for _, t, n in blocks])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    project: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None
    centres: np.ndarray
    levels: np.ndarray

    def features(self, texts: pa.Array) -> np.ndarray:
        z = np.clip((statistics(texts) - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.project + self.phase)
        return np.column_stack([np.ones(len(z)), waves])

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.levels[0])
        return np.clip(np.interp(self.features(texts) @ self.weights, self.centres, self.levels), 0, 1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, square = 0, 0.0, 0.0
    for batch in pieces(batches):
        s = statistics(batch.column(0))
        n, total, square = n + len(s), total + s.sum(axis=0), square + (s**2).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()]), pa.array([square.tolist()])], names=["n", "total", "square"])


def _normal_equations(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(model.phase) + 1
        gram, moment = np.zeros((d, d)), np.zeros(d)
        for batch in pieces(batches, 0):
            x, y = model.features(batch.column(0)), batch.column(1).to_numpy()
            gram += x.T @ x
            moment += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([moment.tobytes()])], names=["gram", "moment"])

    return run


def _raw(model: QualityModel, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(model.features(batch.column(0)) @ weights), batch.column(1)], names=["raw", "y"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = 20_000, waves: int = 256, width: float = 1.0, ridge: float = 1e-2, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on at most about ``train_rows`` labelled rows; a fifth of them calibrates.

    What reaches the driver is ``PARTS`` sums of fixed size and the calibration
    rows' (score, label).
    """
    sample = training_sample(docs, labels, label, train_rows, id_col, text_col).withColumn("part", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(5)))
    sample = sample.repartition(PARTS, "id").persist()
    try:
        sums = sample.select("text").mapInArrow(_moments, "n long, total array<double>, square array<double>").collect()
        tally = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
        rng = np.random.Generator(np.random.PCG64(seed))
        d = 12 + len(CLASSES)
        project, phase = rng.standard_normal((d, waves)) / (width * np.sqrt(d)), rng.uniform(0, 2 * np.pi, waves)
        n = max(1, tally[0])
        base = np.array([tally[1] / n if tally[0] else 0.5])
        mean = sum((np.array(r["total"]) for r in sums), np.zeros(d)) / n
        spread = np.sqrt(np.maximum(sum((np.array(r["square"]) for r in sums), np.zeros(d)) / n - mean**2, 0))
        model = QualityModel(mean, np.where(spread > 1e-9, spread, 1), project, phase, None, base, base)
        if not 0 < tally[1] < tally[0]:
            return model
        fit, rest = sample.where("part > 0").select("text", "y"), sample.where("part = 0").select("text", "y")
        gram, moment = np.zeros((waves + 1, waves + 1)), np.zeros(waves + 1)
        for r in fit.mapInArrow(_normal_equations(model), "gram binary, moment binary").collect():
            gram += np.frombuffer(bytes(r["gram"])).reshape(waves + 1, -1)
            moment += np.frombuffer(bytes(r["moment"]))
        weights = np.linalg.solve(gram + ridge * np.eye(waves + 1), moment)
        held = rest.mapInArrow(_raw(model, weights), "raw double, y double").collect()
        if held:
            model.centres, model.levels = isotonic(np.array([r["raw"] for r in held]), np.array([r["y"] for r in held]))
            model.weights = weights
        return model
    finally:
        sample.unpersist()


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.value.scores(batch.column(2)), pa.float64())], names=["id", "held_out", "score"])

    return run


def scored(docs: DataFrame, model, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, held_out, score and predicted by a fitted model (this one or another with ``scores``)."""
    modest_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(_scored(sent), "id long, held_out boolean, score double")
    return found.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
