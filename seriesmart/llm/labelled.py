"""Bounded samples of labelled documents, and logistic calibration."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` training documents of each class.

    Rows of one id that contradict each other, labels other than 0 and 1 and null ids are left
    out. The choice is the lowest hashes of the ids that documents have, taken by top-k per
    class, so it depends neither on order nor on partitions. The chosen ids, twice ``per_class``
    at most, are broadcast to the documents. Of repeated rows of an id one text comes, that of
    the lowest hash, so the bound holds for rows.
    """
    agreed = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & train)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_most"))
        .filter("label = _most")
        .select("doc_id", F.col("label").cast("int"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    mixed = F.xxhash64("doc_id")
    chosen = [agreed.filter(F.col("label") == c).orderBy(mixed, "doc_id").limit(per_class) for c in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(ids), "doc_id"
    )
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return found.groupBy("doc_id", "label").agg(least.alias("least")).select("doc_id", "least.text", "label")


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights, the last one constant, of a ridge logistic regression by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))
