import math

import numpy as np

from datasheaf.llm import toxicity


def test_thresholds_are_ordered_and_shared():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 400)
    rows = [([0, 1], [float(g) + rng.normal(0, 0.3), rng.normal()]) for g in grades]
    w, b = toxicity.fit_ordinal(rows, grades, grades, np.ones(400), 2, 3)
    assert list(b) == sorted(b) and w[0] > 5 * abs(w[1])
    model = toxicity.SeverityModel({}, w, b)
    expected = model.at_least(np.array([w[0] * g for g in range(4)])).sum(axis=1)
    assert list(expected) == sorted(expected) and abs(expected - np.arange(4)).max() < 0.6


def plain_objective(p, x, low, high, weight, penalty):
    """Penalised negative log-likelihood, row by row."""
    w, b = p[: x.shape[1]], np.concatenate(([-np.inf], p[x.shape[1] :], [np.inf]))
    total = 0.0
    for row, lo, hi, m in zip(x, low, high, weight, strict=True):
        at_least = [1 / (1 + math.exp(min(500, k - row @ w))) if k > -np.inf else 1.0 for k in b]
        total -= m * math.log(at_least[lo] - at_least[hi + 1])
    return total / weight.sum() + penalty * (w @ w) / 2


def test_fit_equals_a_plain_optimiser():
    """Grades known exactly and as intervals: descent along numeric slopes ends at the same weights and thresholds."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 2))
    grade = np.clip(np.round(x[:, 0] - 0.5 * x[:, 1] + rng.logistic(size=120) * 0.7 + 0.6), 0, 2).astype(int)
    unsure = (grade > 0) & (rng.random(120) < 0.4)
    low, high = np.where(unsure, 1, grade), np.where(unsure, 2, grade)
    weight = rng.uniform(0.5, 2, 120)
    w, b = toxicity.fit_ordinal([([0, 1], list(r)) for r in x], low, high, weight, 2, 2, rounds=3000, penalty=0.01, rate=0.02)
    p = np.array([0.0, 0.0, 0.0, 1.0])
    for _ in range(400):
        slope = np.array([(plain_objective(p + h, x, low, high, weight, 0.01) - plain_objective(p - h, x, low, high, weight, 0.01)) / 2e-5 for h in np.eye(4) * 1e-5])
        p = p - 2.0 * slope
    assert np.allclose(np.concatenate((w, b)), p, atol=0.02)


def test_features_speak_for_and_against(spark):
    texts = [(i, f"weather calm number{i}", 0, 1) for i in range(30)] + [(100 + i, f"awful nasty number{i}", 1, i % 2) for i in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in texts], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, x, q in texts], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.weights[model.index["awful"]] > 0 > model.weights[model.index["calm"]]
    assert list(model.thresholds) == sorted(model.thresholds)


def test_held_out_labels(spark, data):
    data = data.replace("sf0.001", "sf0.01")
    documents, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 2 = 0")
    judged = toxicity.judge_toxicity(documents, train).join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert judged and sum(r.toxic == bool(r.label) for r in judged) / len(judged) > 0.9
    assert all(0 <= r.severity <= 2 and r.p_toxic >= r.p_severe for r in judged)


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 0), (8, 1), (8, 0), (None, 1), (2, None)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0)):
        got = toxicity.judge_toxicity(edges, known)
        assert got.count() == edges.count() and not [r for r in got.collect() if r.severity is None]
        assert toxicity.judge_toxicity(nothing, known).count() == 0
    kept = toxicity.clean_documents(edges, labels)
    assert kept.columns == edges.columns and kept.count() == edges.count()
