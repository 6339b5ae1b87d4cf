"""Sample bounds, tree splits, weighted curves and small samples of the
classifiers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewx.llm import quality_crf, toxicity_gbt


@pytest.fixture(scope="module")
def copies(spark):
    """One doc_id held by most rows, of both labels' documents."""
    docs = spark.range(4000).select(F.when(F.col("id") < 3600, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).coalesce(2)
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    return docs, labels


def test_rows_of_one_id_are_sampled_apart(copies):
    docs, labels = copies
    rows = quality_crf.labelled_sample(docs, labels, F.lit(True), "quality", 100).collect()
    n = {y: sum(r.y == y for r in rows) for y in (0, 1)}
    assert {r.y: r.n for r in rows} == {0: 200, 1: 3800}
    assert 60 < n[0] < 140 and 60 < n[1] < 140


def test_the_sample_is_bounded_in_bytes(copies, monkeypatch):
    docs, labels = copies
    monkeypatch.setattr(quality_crf, "SAMPLE_BYTES", 40_000)
    rows = quality_crf.labelled_sample(docs, labels, F.lit(True), "quality", 10**9, line_bytes=100).collect()
    size = sum(len(r.text) + 100 for r in rows)
    assert 25_000 < size < 55_000


def brute_isotonic(m, y, w):
    """Least squares over non-decreasing step functions: min-max formula."""
    order = np.argsort(m, kind="stable")
    y, w = y[order], w[order]
    n = len(y)
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    return m[order], np.array([max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])


def test_isotonic_curve_is_the_weighted_one():
    rng = np.random.default_rng(3)
    m, w = rng.permutation(40).astype(float), rng.integers(1, 9, 40).astype(float)
    y = (m + rng.normal(0, 15, 40) > 20).astype(int)
    knots, levels = toxicity_gbt.isotonic(m, y, w)
    at, want = brute_isotonic(m, y, w)
    got = np.interp(at, knots, levels)
    # Levels are shrunk towards one half by one row's weight.
    sums = {v: w[np.argsort(m, kind="stable")][want == v].sum() * 40 / w.sum() for v in set(want)}
    assert got == pytest.approx(np.array([(v * sums[v] + 0.5) / (sums[v] + 1) for v in want]))


def test_the_curve_follows_the_corpus_not_the_sample():
    """Toxic texts are half of the sample and a tenth of the corpus."""
    rng = np.random.default_rng(5)
    y = np.arange(2000) % 2
    m = np.where(rng.random(2000) < 0.2, 1 - y, y).astype(float)  # a feature wrong in a fifth
    share = np.where(y == 1, 0.1, 0.9)
    knots, levels = toxicity_gbt.isotonic(m, y, share)
    assert np.interp(1.0, knots, levels) == pytest.approx(0.08 / (0.08 + 0.18), abs=0.04)
    c = quality_crf.logistic(m, y, share)
    assert 1 / (1 + np.exp(-(c[0] + c[1]))) == pytest.approx(0.08 / (0.08 + 0.18), abs=0.04)


def test_the_first_split_is_the_best_one(monkeypatch):
    monkeypatch.setattr(toxicity_gbt, "TREES", 1)
    monkeypatch.setattr(toxicity_gbt, "DEPTH", 1)
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (200, 3)).astype(float)
    y = ((x[:, 1] > 7) ^ (rng.random(200) < 0.1)).astype(int)
    trees = toxicity_gbt.boost(x, y)
    g, h = np.full(200, y.mean()) - y, np.full(200, y.mean() * (1 - y.mean()))

    def gain(f, c):
        left = x[:, f] <= c
        part = [g[s].sum() ** 2 / (h[s].sum() + toxicity_gbt.LAMBDA) for s in (left, ~left)]
        return sum(part)

    best = max(((gain(f, c), f, c) for f in range(3) for c in range(11)), key=lambda b: b[0])
    assert trees["feature"][0][0] == best[1] == 1 and np.floor(trees["cutoff"][0][0]) == best[2]
    right = x[:, 1] > trees["cutoff"][0][0]
    want = [-toxicity_gbt.RATE * g[s].sum() / (h[s].sum() + toxicity_gbt.LAMBDA) for s in (~right, right)]
    assert trees["value"][0] == pytest.approx(want)


@pytest.mark.parametrize("n", [2, 3, 5, 30])
def test_small_samples_are_fitted_alike(spark, n):
    rows = [(i, "you idiot and moron" if i % 2 else "a fine day in the park", "x") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string").coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    model = toxicity_gbt.train(docs, labels, F.lit(True))
    scores = [r.score for r in toxicity_gbt.score(docs, model).collect()]
    assert len(scores) == n and all(0 <= s <= 1 for s in scores)
