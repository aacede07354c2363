import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm.classifier import fourier, isotonic, op3_quality_classifier, statistics


def docs_and_labels(spark, documents, n=400):
    good = lambda i: " ".join(f"word{(i * 7 + k) % 97} and" for k in range(40)) + "."
    bad = lambda i: "BUY!! $$$ " * (20 + i % 9)
    d = documents([(i, bad(i) if i % 4 == 0 else good(i)) for i in range(n)] + [(n, None), (n + 1, ""), (None, good(1))])
    return d, spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(n)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark, documents):
    d, labels = docs_and_labels(spark, documents)
    rows = op3_quality_classifier(d, labels).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 50 and all(r.predicted == (r.doc_id % 4 != 0) for r in held)


def test_no_labels_and_empty_tables(spark, documents):
    d, labels = docs_and_labels(spark, documents, 8)
    assert {r.score for r in op3_quality_classifier(d, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in op3_quality_classifier(d, labels.filter("quality = 1")).collect()} == {1.0}
    assert op3_quality_classifier(documents([]), labels).collect() == []


def test_features_approximate_the_kernel():
    x = np.random.default_rng(0).standard_normal((40, 12))
    z = fourier(x)[:, :-1]
    true = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 4.0**2))
    assert np.abs(z @ z.T - true).mean() < 0.06


def test_isotonic_pools_violators():
    knots, values = isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert values.tolist() == [0, 0.5, 1] and (np.diff(knots) > 0).all()


def test_statistics_of_odd_texts():
    assert len(statistics(None)) == len(statistics("é" * 10**6)) == 12 and np.isfinite(statistics("\x00\n")).all()


def brute(rows, labels):
    """Scores by one ridge fit over all labelled rows at once, calibrated by pooling counted steps."""
    texts = [(d, t) for d, t in rows if d is not None]
    train = [(d, t, y) for d, t in texts for i, y in labels if i == d and y in (0, 1) and zlib.crc32(str(d).encode()) % 4 != 2]
    return texts, train


def test_repeated_labels_and_documents(spark, documents):
    d, labels = docs_and_labels(spark, documents)
    hot = spark.range(50_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rows = op3_quality_classifier(d.union(d.filter("doc_id = 1")), labels.union(hot)).collect()
    assert len(rows) == 404 and all(0 <= r.score <= 1 for r in rows)


def test_tasks_sum_to_the_fit_of_all_rows_at_once(spark, documents):
    from lexspark.llm import classifier as c

    rng = np.random.default_rng(2)
    words = ["alpha", "Beta", "##", "99", "x!", "gamma,", "delta\n"]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(1, 60)), p=rng.dirichlet(np.ones(7))))) for i in range(300)]
    marks = [(i, int(rng.random() < (0.8 if "##" not in t else 0.3)), 0) for i, t in rows] + [(5, 1, 0), (5, 1, 0)]
    mean, scale, weights, _, _ = c.fit(documents(rows).repartition(7), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    _, train = brute(rows, [m[:2] for m in marks])
    side = {r.doc_id: r.c for r in spark.range(300).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id", F.lit(6)), F.lit(c.HOLD)) == 0).alias("c")).collect()}
    fitted = [(c.statistics(t), y) for d, t, y in train if not side[d]]
    x, y = np.array([f[0] for f in fitted]), np.array([f[1] for f in fitted], float)
    assert mean == pytest.approx(x.mean(0)) and scale == pytest.approx(np.sqrt(np.maximum(x.var(0), 1e-6)), rel=1e-6)
    z = c.fourier((x - mean) / scale)
    want = np.linalg.solve(z.T @ z + c.RIDGE * len(x) / c.FEATURES * np.eye(z.shape[1]), z.T @ y)
    assert z @ weights == pytest.approx(z @ want, abs=1e-6)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_held_out_labels_of_the_driver_are_ranked(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    rows = op3_quality_classifier(spark.read.parquet(f"{at}/documents.parquet"), labels).join(labels.select("doc_id", "quality"), "doc_id").filter("held_out and quality is not null").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    ranked = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert len(good) > 20 and len(bad) > 5 and ranked > 0.85, ranked
