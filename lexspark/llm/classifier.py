"""Operator 3: document quality by random Fourier features, ridge regression, isotonic calibration.

A document's statistics (shares of symbols, capitals, digits, repeated words and lines, lengths)
are standardised and mapped to cosines of random projections, which approximate a Gaussian kernel.
Each task sums its part of the normal equations; the sums are added up in PARTS tasks, then on the
driver, and solved with a ridge. Scores of training rows held back from that fit are counted in steps
of 1/STEPS and calibrated by pool-adjacent-violators to the share of label 1, and the calibrated
steps, joined linearly, score every document.

About TRAIN_ROWS labelled documents, those with the smallest hashes of doc_id, are used to train (all,
if there are fewer); everything else covers all rows. Only the text enters a score. What reaches the
driver are sums and a count for each step of the score.

Defined results: a null text is an empty one, and empty texts get the score of their statistics;
labels that are null or not 0 or 1 are not used; with no usable labels, or labels of one kind only,
every score is the share of label 1 (0.5 with none); a doc_id labelled twice counts as often; a null
doc_id is scored and never trained on, and is not held out; an empty table gives an empty table;
only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast, slices

#: Labelled documents used in training: expected number, if there are more.
TRAIN_ROWS = 20_000
FEATURES, BANDWIDTH, RIDGE = 256, 4.0, 1e-2
#: One training row in so many calibrates instead of fitting.
HOLD = 4
THRESHOLD = 0.7
#: Tasks that add up what all tasks have summed, and steps of a score in calibration.
PARTS, STEPS = 16, 1000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT, _PUNCT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91], _DIGIT[48:58] = True, True
_PUNCT[list(b"!?.,;:-'\"()[]{}/\\=+_~^`@")] = True


def statistics(text: str | None) -> list[float]:
    """Twelve numbers about a text, none of which grows without bound with its length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    runs = list(zip(words, words[1:], words[2:], words[3:], strict=False))
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / n),
        min(3.0, counts[_SYMBOLS].sum() / n),
        min(3.0, counts[33] / n),
        counts[_UPPER].sum() / size,
        counts[_DIGIT].sum() / size,
        min(3.0, counts[_PUNCT].sum() / n),
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(runs)) / max(1, len(runs)),
        stutter / n,
        math.log1p(max(map(len, words), default=0)),
    ]


N_STATS = 12
_RNG = np.random.default_rng(3)
_PROJECT = _RNG.standard_normal((N_STATS, FEATURES)) / BANDWIDTH
_PHASE = _RNG.uniform(0, 2 * np.pi, FEATURES)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    return np.hstack([np.cos(x @ _PROJECT + _PHASE) * math.sqrt(2 / FEATURES), np.ones((len(x), 1))])


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of label on score: pooled scores and pooled means."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, y, w in zip(score[order], label[order], (np.ones(len(score)) if weight is None else weight)[order], strict=True):
        pools.append([s, y, float(w)])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            (s1, y1, n1), (s2, y2, n2) = pools[-2:]
            pools[-2:] = [[(s1 * n1 + s2 * n2) / (n1 + n2), (y1 * n1 + y2 * n2) / (n1 + n2), n1 + n2]]
    return np.array([p[0] for p in pools]), np.array([p[1] for p in pools])


def _stats(batches):
    import pyarrow as pa

    for batch in slices(batches):
        x = [statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64())), batch.column(2), batch.column(3)], names=["doc_id", "x", "label", "weight"])


def _arrays(batch):
    x = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, N_STATS)
    return x, batch.column(1).to_numpy().astype(np.float64), batch.column(2).to_numpy().astype(np.float64)


def _sums(total: np.ndarray):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _moments(batches):
    """Weight, weighted sums and sums of squares of a task's statistics."""
    total = np.zeros(2 * N_STATS + 1)
    for batch in batches:
        x, _, w = _arrays(batch)
        total += np.concatenate([[w.sum()], w @ x, w @ (x * x)])
    yield _sums(total)


def _normal(mean, scale):
    """A task's part of the normal equations: features by features, then features by label."""

    def run(batches):
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            x, y, w = _arrays(batch)
            z = fourier((x - mean) / scale)
            a += (z * w[:, None]).T @ z
            b += z.T @ (w * y)
        yield _sums(np.concatenate([a.ravel(), b]))

    return run


def _added(batches):
    total = None
    for batch in batches:
        for part in batch.column(0).to_pylist():
            one = np.frombuffer(part)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield _sums(total)


def _summed(x: DataFrame, part) -> np.ndarray | None:
    """The sum of what part gives for each task of x, added up in PARTS tasks and then here."""
    added = x.select("x", "label", "weight").mapInArrow(part, "sums binary").repartition(PARTS).mapInArrow(_added, "sums binary").collect()
    return np.sum([np.frombuffer(r[0]) for r in added], axis=0) if added else None


def _raw(mean, scale, weights):
    """(x, label, weight) to (step, label, weight): the uncalibrated score in steps."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, _, _ = _arrays(batch)
            step = np.rint(fourier((x - mean) / scale) @ weights * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int64()), batch.column(1), batch.column(2)], names=["step", "label", "weight"])

    return run


def _score(mean, scale, weights, knots, values):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.float64).reshape(-1, N_STATS)
            raw = fourier((x - mean) / scale) @ weights
            score = np.clip(np.interp(raw, knots, values), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
    """(mean, scale, weights, knots, values) learned from labelled rows that are not held out."""
    scratch = Scratch(docs.sparkSession, "classifier")
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)").filter(~held_out())
    # Equal labels of a document are one row with a weight, so that a document brings two at most.
    chosen = scratch.store(chosen.groupBy("doc_id", "label").agg(F.count("*").alias("weight")), "labels")
    share = min(1.0, rows / max(1, chosen.count()))
    chosen = scratch.store(chosen.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 32)) < int(share * (1 << 32))), "drawn-labels")
    used = docs.select("doc_id", "text").join(checked_broadcast(chosen, 24), "doc_id")
    x = scratch.store(used.select("doc_id", "text", "label", "weight").mapInArrow(_stats, "doc_id long, x array<double>, label int, weight long"), "statistics")
    x = x.withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(HOLD)) == 0)
    fitted = x.filter("not calibrates")
    sums = _summed(fitted, _moments)
    level, kinds = x.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight"), F.count_distinct("label")).first()
    if sums is None or sums[0] == 0 or kinds < 2:
        return np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5 if level is None else float(level))
    n = float(sums[0])
    mean = sums[1 : N_STATS + 1] / n
    scale = np.sqrt(np.maximum(sums[N_STATS + 1 :] / n - mean**2, 1e-6))
    total = _summed(fitted, _normal(mean, scale))
    a, b = total[: (FEATURES + 1) ** 2].reshape(FEATURES + 1, -1), total[(FEATURES + 1) ** 2 :]
    weights = np.linalg.solve(a + RIDGE * n / FEATURES * np.eye(FEATURES + 1), b)

    def counted(some):
        step = some.select("x", "label", "weight").mapInArrow(_raw(mean, scale, weights), "step long, label int, weight long")
        return step.groupBy("step").agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("y"), F.sum("weight").alias("w")).orderBy("step").collect()

    held = counted(x.filter("calibrates")) or counted(x)
    knots, values = isotonic(np.array([r["step"] for r in held]) / STEPS, np.array([r["y"] for r in held]), np.array([r["w"] for r in held], float))
    return mean, scale, weights, knots, values


def score_quality(docs: DataFrame, model) -> DataFrame:
    """Per document: doc_id, score."""
    return docs.select("doc_id", "text").mapInArrow(_score(*model), "doc_id long, score double")


def op3_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
