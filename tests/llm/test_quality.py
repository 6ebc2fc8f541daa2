import numpy as np
from pyspark.sql import functions as F

from helpers import SF_DIR, awkward, documents
from sluicegate.llm import quality
from sluicegate.llm.queries import op9_quality


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = op9_quality(spark, "/root/testdata/sf0.01")
    assert found.where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").isEmpty()
    held = found.where("held_out").join(labels, "doc_id")
    assert held.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()[0] > 0.95


def test_preferences_order_the_scores():
    rng = np.random.default_rng(0)
    width = quality.SHAPES + quality.STATISTICS
    x = rng.random((400, width))
    good, bad = x[x[:, 3] > 0.55], x[x[:, 3] < 0.45]
    model = quality.fit(good, bad)
    assert model.score(good).min() > model.score(bad).max() and (model.score(good) >= 0.7).mean() > 0.97
    assert (model.score(bad) < 0.7).mean() > 0.97
    tenth = quality.fit(good, bad, quantile=0.1)
    assert abs((tenth.score(np.concatenate([good, bad])) < 0.7).mean() - 0.1) < 0.02


def test_without_both_labels_every_score_is_the_threshold(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 5)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = quality.score(docs, model, keep=("doc_id", "text"))
    assert {r.quality_score for r in got.collect()} == {0.7} or all(abs(r.quality_score - 0.7) < 1e-12 for r in got.collect())


def test_awkward_rows(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.learn(df, labels.unionByName(labels))
    again = quality.learn(df.repartition(5), labels)
    assert np.allclose(model.weights, again.weights)
    rows = awkward()
    got = quality.score(documents(spark, rows), model, keep=("text",)).collect()
    assert sorted(repr(r.text) for r in got) == sorted(repr(t) for _, t in rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text or None, set()).add(r.quality_score)
    assert all(len(s) == 1 and 0 <= min(s) <= 1 for s in by_text.values())
    assert quality.score(documents(spark, []), model).collect() == []


def test_fit_against_plain_logistic_regression_on_all_pairs():
    """Newton's method on every pair of a good and a bad text; the operator draws pairs and takes gradient steps."""
    rng = np.random.default_rng(5)
    few, width = 6, quality.SHAPES + quality.STATISTICS
    good, bad = np.zeros((40, width)), np.zeros((50, width))
    good[:, :few], bad[:, :few] = rng.standard_normal((40, few)) + 0.4, rng.standard_normal((50, few)) - 0.4
    model = quality.fit(good, bad, pairs=1_000_000, rounds=2000, penalty=1e-3)
    x = np.concatenate([good, bad])[:, :few]
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    d = (x[:40, None] - x[None, 40:]).reshape(-1, few)
    w = np.zeros(few)
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        slope = d.T @ (1 - p) / len(d) - 1e-3 * w
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(few), slope)
    assert np.abs(slope).max() < 1e-9
    assert np.allclose(model.weights[:few], w, rtol=0.03, atol=0.01) and not model.weights[few:].any()
    raw = model.raw(np.concatenate([good, bad]))
    order = np.argsort(x @ w)
    assert (np.diff(raw[order]) > -0.05).all()
