"""Toxicity by cumulative-link ordinal regression.

One weight vector over sparse text features serves all grades; ordered
thresholds cut its scale: P(grade >= k) = s(w.x - b_k) with b_1 < b_2. The
result is the expected grade.

Grades come from the labels alone, never from the text: 0 is harmless, 1 toxic,
2 toxic and of poor quality besides. Where a toxic document's quality isn't
labelled, its grade is 1 or 2, and the likelihood is that of the interval.

Fitting takes a bounded sample of labelled documents (``SAMPLE`` of each
class, those with the smallest hash of their id); scoring reads all documents
whole and needs no shuffle. What workers get is the weights of ``FEATURES``
features at most.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import per_row, staged

#: Labelled documents of each class that the fit may read.
SAMPLE = 3000
#: Features kept, by how strongly they speak for or against.
FEATURES = 4096
PREFIXES = (4, 5, 6)
#: Grades beyond 0, and so thresholds.
GRADES = 2
#: A feature is typical of a class if its documents have it this much more often (log of the ratio), by so many standard errors.
TYPICAL, ERRORS = 1.0, 2.0
#: Expected severity from which a document is toxic.
THRESHOLD = 0.2
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: bytes) -> Counter[str]:
    return Counter(WORD.findall(text.decode().lower()))


def features_of(word: str) -> tuple[str, ...]:
    """The word itself, and its beginnings, which stand for its inflected forms."""
    return (word, *[f"{word[:n]}-" for n in PREFIXES if len(word) > n])


@dataclass
class SeverityModel:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def vector(self, words: Counter[str]) -> tuple[list[int], list[float]]:
        """Indices and values of the features."""
        counts: Counter[int] = Counter()
        get = self.index.get
        for w, c in words.items():
            for f in (w, w[:4] + "-", w[:5] + "-", w[:6] + "-") if len(w) > 6 else features_of(w):
                if (i := get(f)) is not None:
                    counts[i] += c
        return list(counts), np.log1p(list(counts.values())).tolist()

    def at_least(self, scale: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. of each value of the scale."""
        return 1 / (1 + np.exp(-np.clip(scale[:, None] - self.thresholds[None, :], -500, 500)))


def fit_ordinal(rows: list[tuple[list[int], list[float]]], low: np.ndarray, high: np.ndarray, weight: np.ndarray, n_features: int, n_grades: int = GRADES, rounds: int = 400, penalty: float = 1e-4, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative link with a quadratic penalty, by Adam over all rows.

    A row's grade is known to be from ``low`` to ``high``; the result is the
    weights and the rising thresholds.
    """
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    col = np.array([x for i, _ in rows for x in i], np.int64)
    val = np.array([x for _, v in rows for x in v], float)
    # thresholds are a first one and positive steps, so they stay ordered
    p = np.zeros(n_features + n_grades)
    p[n_features] = 2.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = max(weight.sum(), 1e-9)
    for t in range(1, rounds + 1):
        w, b = p[:n_features], np.cumsum(np.concatenate(([p[n_features]], np.exp(p[n_features + 1 :]))))
        scale = np.bincount(at, w[col] * val, len(rows))
        s = 1 / (1 + np.exp(-np.clip(scale[:, None] - b[None, :], -30, 30)))  # P(grade >= k)
        edge = np.concatenate((np.ones((len(rows), 1)), s, np.zeros((len(rows), 1))), axis=1)
        slope = edge * (1 - edge)
        i = np.arange(len(rows))
        chance = np.maximum(edge[i, low] - edge[i, high + 1], 1e-12)
        up, down = weight * slope[i, low] / chance / n, weight * slope[i, high + 1] / chance / n
        d_scale = up - down
        g = np.zeros_like(p)
        g[:n_features] = -np.bincount(col, d_scale[at] * val, n_features) + penalty * w
        d_b = np.zeros(n_grades + 2)
        np.add.at(d_b, low, up)
        np.add.at(d_b, high + 1, -down)
        tail = np.cumsum(d_b[1:-1][::-1])[::-1]
        g[n_features] = tail[0]
        g[n_features + 1 :] = tail[1:] * np.exp(p[n_features + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:n_features], np.cumsum(np.concatenate(([p[n_features]], np.exp(p[n_features + 1 :]))))


def sample_labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(toxic, poor, text) of the sampled documents, and the labelled documents of each class.

    Several labels of a document: the worst counts. ``poor`` is null where
    ``labels`` has no quality for the document, or no such column.
    """
    quality = F.col("quality") if "quality" in labels.columns else F.lit(None).cast("int")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"), F.max((quality == 0).cast("int")).alias("poor"))
    ids = docs.select(F.col(id_col).alias("doc_id")).distinct()
    known = staged(known.join(ids, "doc_id", "left_semi"), "labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * sample rows
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(few, "doc_id")
    return staged(texts.select("toxic", "poor", "text"), "sample"), sizes


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> SeverityModel:
    """Fit on a sample of ``labels`` (doc_id, toxic, quality). Without toxic labels no feature has weight and every severity is near 0."""
    texts, sizes = sample_labelled(docs, labels, sample, id_col, text_col)

    def in_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n[toxic].update({f for w in words_of((text or "").encode()) for f in features_of(w)})
        names = list(n[0] | n[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[0][f] for f in names], pa.int64()), pa.array([n[1][f] for f in names], pa.int64())], names=["feature", "clean", "toxic"])

    taken = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = taken.get(0, 0), taken.get(1, 0)
    counts = texts.select("toxic", "text").mapInArrow(in_documents, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    log_ratio = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    errors = F.abs("ratio") / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    typical = counts.withColumn("ratio", log_ratio).withColumn("errors", errors).filter((F.abs("ratio") >= TYPICAL) & (F.col("errors") >= ERRORS)).orderBy(F.desc("errors"), "feature").limit(FEATURES)
    model = SeverityModel({}, np.zeros(0), np.full(GRADES, 10.0))
    if n_toxic:
        model.index = {r["feature"]: i for i, r in enumerate(typical.collect())}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.vector(words_of((x or "").encode())) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["toxic", "poor", "at", "value"])

    model.weights = np.zeros(len(model.index))
    rows = texts.mapInArrow(vectors, "toxic int, poor int, at array<bigint>, value array<double>").collect() if model.index else []
    if not rows:
        return model
    rows.sort(key=lambda r: (r["toxic"], r["poor"] is None, r["poor"] or 0, r["at"], r["value"]))
    toxic = np.array([r["toxic"] for r in rows])
    low = toxic + np.array([r["toxic"] * (r["poor"] or 0) for r in rows])
    high = np.array([r["toxic"] * (GRADES if r["poor"] is None else 1 + r["poor"]) for r in rows])
    # the sample takes more of the rarer class; weights restore the shares among the labelled
    weight = np.where(toxic == 0, sizes.get(0, 0) / max(n_clean, 1), sizes.get(1, 0) / max(n_toxic, 1))
    model.weights, model.thresholds = fit_ordinal([(list(r["at"]), list(r["value"])) for r in rows], low, high, weight / weight.mean(), len(model.index))
    return model


def score(docs: DataFrame, model: SeverityModel, keep: list, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, then p_toxic, p_severe (grade 1 or above, grade 2), severity, toxic."""

    def severities(texts: list[bytes]) -> list[pa.Array]:
        found = [model.vector(words_of(t)) for t in texts]
        scale = np.array([sum(model.weights[i] * v for i, v in zip(at, values, strict=True)) for at, values in found], float)
        p = model.at_least(scale)
        total = p.sum(axis=1)
        return [*(pa.array(p[:, k]) for k in range(GRADES)), pa.array(total), pa.array(total >= threshold)]

    return per_row(docs, keep, F.col(text_col), severities, "p_toxic double, p_severe double, severity double, toxic boolean")


def judge_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, p_toxic, p_severe, severity, toxic.

    Null and empty texts have no features and the severity of none. Null ids
    are scored but not used to fit; repeated rows stay; other columns aren't
    read; an empty table gives no rows.
    """
    return score(docs, fit(docs, labels, id_col=id_col, text_col=text_col), [F.col(id_col).alias("doc_id")], text_col)


def clean_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that judge_toxicity doesn't call toxic, with all their columns.

    Column names may clash with the results'. Null and empty texts have no
    features and stay, as do all rows without toxic labels to learn from;
    repeated rows are judged alike; no rows give no rows.
    """
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    judged = score(numbered, model, [F.col(c) for c in numbered.columns], f"c{names.index(text_col)}")
    return judged.filter(~F.col("toxic")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
