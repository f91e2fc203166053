"""Bounded labelled samples and calibration for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import fold

FOLDS = 5


def first_by_hash(rows: DataFrame, h: str, k: int, n: int) -> DataFrame:
    """The ``k`` rows of ``rows`` (about ``n``) with the smallest hash ``h``. A cut
    on the hash leaves some 2 k candidates before the sort, so what the sort
    gathers does not grow with the number of tasks."""
    share = min(1.0, (2 * k + 1000) / max(n, 1))
    cut = min(int(share * 2.0 ** 64) - (1 << 63), (1 << 63) - 1)
    return rows.filter(F.col(h) <= F.lit(cut)).orderBy(h).limit(k)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int = FOLDS) -> DataFrame:
    """(doc_id, text, y, part) of up to ``per_class`` documents of each label,
    the first in hash order, none of the held-out fold; ``part`` is 0 or 1.

    The ids come from a top-k per class (at most ``2 * per_class`` rows, which
    is the bound of the broadcast); texts are picked up in one scan. Documents
    without id or text, and further rows of an id, are left out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
                   .filter(F.col("y").isin(0, 1) & (fold(F.col("doc_id"), folds) != 0))
                   .groupBy("doc_id").agg(F.max("y").alias("y")))
    known = known.withColumn("h", F.xxhash64("doc_id", F.lit(11)))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    picked = [first_by_hash(known.filter(F.col("y") == y), "h", per_class, sizes.get(y, 0)).drop("h") for y in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.filter(F.col("text").isNotNull()).join(ids, "doc_id")
                .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
                .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2)).cast("int")))


def platt(x: np.ndarray, y: np.ndarray, prior: float | None = None, ridge: float = 1e-3) -> tuple[float, float]:
    """(slope, intercept) of a logistic curve through scores and 0/1 labels;
    with ``prior``, for classes of that share instead of the sample's."""
    if not len(x) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return 0.0, float(np.log(p / (1 - p)))
    scale = x.std() or 1.0
    a = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1)
    share = y.mean() if prior is None else prior
    w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) / len(x) + ridge * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a / len(x) + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = beta[0] / scale
    return float(slope), float(beta[1] - slope * x.mean())


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
