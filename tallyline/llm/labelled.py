"""Bounded samples of labelled rows, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    held_out_of: int = 4, held_out: int = 2,
) -> DataFrame:
    """``id``, ``label``, ``order`` and ``text`` of at most ``rows`` labelled rows of each label, chosen by a hash of the id.

    Rows whose id's remainder is ``held_out`` are never taken. The choice is made among the labels, so at most
    ``2 * rows`` ids go to all tasks. Of rows of one id with a text, that of the smallest hash of the text is taken. A
    label is 0 or 1; others, and ids with both, are left out.
    """
    marked = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(id_remainder("id", held_out_of) != held_out)
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
        .select("id", "label", F.xxhash64("id").alias("order"))
    )
    chosen = marked.where("label = 0").orderBy("order", "id").limit(rows).union(
        marked.where("label = 1").orderBy("order", "id").limit(rows)
    )
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").where("octet_length(text) > 0")
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    return found.groupBy("id").agg(F.first("label").alias("label"), F.first("order").alias("order"), one)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, the constant first; columns are standardised inside."""
    mean, scale = x.mean(0), x.std(0) + 1e-12
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * len(x) * np.r_[0, w[1:]]
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(x) * np.eye(len(w)) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    plain = w[1:] / scale
    return np.r_[w[0] - (plain * mean).sum(), plain]


def probability(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
