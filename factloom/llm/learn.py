"""Small models fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept, which is not shrunk."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    w, c = np.zeros(x.shape[1]), np.ones(len(x)) if weight is None else weight
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (c * (p - y)) + ridge * w
        h = (x * (c * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        move = np.linalg.solve(h, g)
        w -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int, keep=None, key: str = "doc_id", *more) -> DataFrame:
    """(key, text, y), and further columns of docs, of at most `limit` labelled keys, chosen by a hash; one row for each.

    y is the label (0 or 1).  Only the bounded list of keys is broadcast.  Rows with a null key or label are not used; of
    contradicting labels for one key the larger holds; of rows of docs with one key that of the least text.
    """
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    if keep is not None:
        rows = rows.where(keep)
    few = rows.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("key"), "key").limit(limit)
    return one_each(docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"), *more).join(F.broadcast(few), "key"))


def one_each(sample: DataFrame) -> DataFrame:
    """One row of a sample for each key; repeats are dropped before rows are shuffled."""
    rest = [c for c in sample.columns if c != "key"]
    return sample.groupBy("key").agg(F.min(F.struct("text", *[c for c in rest if c != "text"])).alias("row")).select("key", *[F.col(f"row.{c}").alias(c) for c in rest])
