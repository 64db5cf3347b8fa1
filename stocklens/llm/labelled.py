"""Bounded samples of labelled documents, and logistic regression on few dense features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import crc32_mod


def held_out(divisor: int, remainder: int) -> F.Column:
    return F.coalesce(crc32_mod("doc_id", divisor) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, remainder: int, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most `limit` labelled doc_ids outside the held-out fold, chosen by hash.

    Rows with a null id or label are left out; an id labelled twice counts by its larger label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(divisor, remainder))
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method; the last weight is the intercept. Only a prior without both classes."""
    if not len(y) or y.min() == y.max():
        return np.concatenate([np.zeros(x.shape[1]), [0.0 if not len(y) else 4.0 * (2 * float(y.max()) - 1)]])
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = l2 * np.eye(len(w))
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) / len(y) + l2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
