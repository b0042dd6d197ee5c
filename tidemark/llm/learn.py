"""Bounded labelled samples and logistic fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, materialise


def label_sample(labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, fold) of up to `per_class` documents of either class, by lowest hash of the
    id, and how many each class has. Only folds 1 to 4: fold 0 is held out. Rows without id or label
    do not count; of several labels of a document the highest does."""
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
             .groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0"))
    known = materialise(known)
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    best = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return best[0].unionByName(best[1]), totals


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; a column of ones is not penalised if last."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[np.ptp(x, axis=0) == 0] = 1e-6 if len(x) else ridge
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
