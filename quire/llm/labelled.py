"""Bounded labelled samples and Platt calibration for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bytes of the longest text that a classifier learns from.
TEXT_BYTES = 1 << 16


def remainder(doc_id, modulus: int):
    """crc32 of the id as text modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, modulus: int = 0, kept_out: int = -1) -> tuple[DataFrame, dict[int, int]]:
    """(rows ``text, y``; number of labelled rows of each class).

    At most ``per_class`` rows of either label, the first by a hash of their
    id; labels that are null or not 0 or 1 are left out, and a document with
    several labels has the largest. Ids in the held-out remainder are never
    read. The ids chosen are bounded by ``2 * per_class`` and are broadcast;
    the texts stay where they are. Texts over ``TEXT_BYTES`` are not learned
    from, and of rows that share an id the one of the smallest text is, so the
    sample is bounded in bytes as well.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if modulus:
        known = known.where(remainder(F.col("doc_id"), modulus) != kept_out)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    totals = {int(r["y"]): int(r["n"]) for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = [
        (int(r["doc_id"]), int(r["y"]))
        for y in (0, 1)
        for r in known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    ]
    ids = docs.sparkSession.createDataFrame(chosen, "chosen_id long, y int")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= TEXT_BYTES)
    rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("chosen_id"))
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y"), totals


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (bias last) of a weighted logistic regression, by damped Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(a.shape[1])
    penalty[-1, -1] = 1e-9
    for _ in range(50):
        p = sigmoid(a @ w)
        grad = a.T @ (weight * (p - y)) + penalty @ w
        hess = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + penalty
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def balance(y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Weights that give the sample the classes' true proportions; mean 1."""
    w = np.array([totals.get(int(v), 0) / max(1, int((y == v).sum())) for v in y], float)
    return w / w.mean() if len(w) else w
