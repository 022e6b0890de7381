"""Latent classes whose shares depend on a row's own features: two or three classes with a multinomial prior.

Rows, not only patterns, have their own posteriors, so a round goes over all
distinct rows: tasks add up log-likelihood, masses, firings, and the slope and
block Gram matrix of one Newton step on the prior, and the driver adds up
the tasks' sums, whose size is that of the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .mixtures import seeded

#: Penalty on squared prior weights for each row, and the longest step of a weight.
RIDGE = 1e-6
LONGEST = 2.0
#: Distinct rows that a task of a round goes over.
ROWS_A_TASK = 20_000


class Priors(NamedTuple):
    """rates: classes x detectors; weights: classes x (1 + features), the last class's being 0; mass and means by class."""

    rates: np.ndarray
    weights: np.ndarray
    loglik: float
    mass: np.ndarray
    means: np.ndarray
    rounds: int


def standardised(frame: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """frame with z_f, (f - mean) / deviation over finite values and 0 where f is missing, and miss_f, 1 there; and the columns' names.

    A flag is given only for features that are missing somewhere, but not everywhere.
    """
    value = {f: F.when(F.isnan(F.col(f).cast("double")) | (F.abs(F.col(f).cast("double")) == float("inf")), None).otherwise(F.col(f).cast("double")) for f in features}
    sums = frame.agg(F.count("*").alias("n"), *[g.alias(f"{k}_{f}") for f, v in value.items() for k, g in (("n", F.count(v)), ("mean", F.avg(v)), ("sd", F.stddev_pop(v)))]).first()
    names = []
    for f, v in value.items():
        mean, sd = sums[f"mean_{f}"] or 0.0, sums[f"sd_{f}"] or 0.0
        frame = frame.withColumn(f"z_{f}", F.coalesce((v - mean) / (sd or 1.0), F.lit(0.0)))
        names.append(f"z_{f}")
        if 0 < sums[f"n_{f}"] < sums["n"]:
            frame = frame.withColumn(f"miss_{f}", v.isNull().cast("double"))
            names.append(f"miss_{f}")
    return frame, names


def _round(rates: np.ndarray, weights: np.ndarray, names: list[str]):
    classes, detectors = rates.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            n = batch.column("n").to_numpy().astype(float)
            bits = ((batch.column("pattern").to_numpy()[:, None] >> np.arange(detectors)) & 1).astype(float)
            x = np.stack([np.ones(len(n)), *(batch.column(c).to_numpy() for c in names)], 1)
            line = x @ weights.T
            prior = np.exp(line - line.max(1, keepdims=True))
            prior /= prior.sum(1, keepdims=True)
            joint = np.log(np.maximum(prior, 1e-300)) + bits @ np.log(rates).T + (1 - bits) @ np.log1p(-rates).T
            most = joint.max(1, keepdims=True)
            whole = most + np.log(np.exp(joint - most).sum(1, keepdims=True))
            post = n[:, None] * np.exp(joint - whole)
            free = prior[:, : classes - 1]
            gram = np.einsum("r,rc,rd,ri,rj->cidj", n, free, free, x, x, optimize=True) * -1
            for c in range(classes - 1):
                gram[c, :, c, :] += (x * (n * free[:, c])[:, None]).T @ x
            total = total + np.concatenate([[n @ whole[:, 0]], post.sum(0), (post.T @ bits).ravel(), (post.T @ x).ravel(), ((n[:, None] * free).T @ x).ravel(), gram.ravel()])
        if np.ndim(total):
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    return sums


def class_priors(frame: DataFrame, detectors: int, features: list[str], classes: int = 3, third: str | None = None, anchor: int = 1, seed: str = "0", rounds: int = 60, tol: float = 1e-7) -> Priors:
    """The model fitted to frame (pattern and features, none null) by EM with one Newton step on the prior a round.

    Rates have Beta(2, 2) priors.  With three classes, the one whose rows have
    the highest mean of the feature third is the second; of the others, or of two
    classes, the one in which the anchor detector fires more often is the first.
    """
    if classes not in (2, 3) or classes == 3 and third not in features:
        raise ValueError("two classes, or three with a feature that tells the second")
    rows = frame.select(F.col("pattern").cast("long").alias("pattern"), *[F.col(f).cast("double").alias(f) for f in features]).groupBy("pattern", *features).agg(F.count("*").alias("n")).cache()
    size = 1 + len(features)
    u = seeded(seed, classes * detectors).reshape(classes, detectors)
    rates = np.concatenate([0.55 + 0.4 * u[:1], 0.02 + 0.1 * u[1:]])
    weights = np.zeros((classes, size))
    weights[:-1, 0] = np.log(0.05 / 0.9)
    if third:
        weights[1, 1 + features.index(third)] = 0.5  # the second class starts where the feature is high
    before, loglik, mass, means, done = -np.inf, -np.inf, np.zeros(classes), np.zeros((classes, size)), 0
    try:
        held = rows.coalesce(max(1, -(-rows.count() // ROWS_A_TASK)))  # tasks by the number of rows, not of the session's partitions
        for done in range(1, rounds + 1):
            made = held.mapInArrow(_round(rates, weights, features), "sums array<double>").collect()  # a row a task, of the model's size
            if not made:
                raise ValueError("no rows to fit a model to")
            sums = np.sum([r["sums"] for r in made], 0)
            loglik, mass = sums[0], sums[1 : 1 + classes]
            cut = np.cumsum([1 + classes, classes * detectors, classes * size, (classes - 1) * size])
            fired, means = sums[cut[0] : cut[1]].reshape(classes, -1), sums[cut[1] : cut[2]].reshape(classes, -1)
            prior, gram = sums[cut[2] : cut[3]].reshape(classes - 1, -1), sums[cut[3] :].reshape((classes - 1) * size, -1)
            if abs(loglik - before) < tol * max(1.0, abs(before)):
                break
            before, n = loglik, mass.sum()
            rates = (fired + 1) / (mass[:, None] + 2)
            slope = (means[:-1] - prior - RIDGE * n * weights[:-1]).ravel()
            step = np.linalg.solve(gram + (RIDGE * n + 1e-9) * np.eye(len(gram)), slope).reshape(classes - 1, -1)
            weights[:-1] += step * min(1.0, LONGEST / max(1e-12, np.abs(step).max()))
    finally:
        rows.unpersist()
    means = means / np.maximum(mass, 1e-9)[:, None]
    order = list(np.argsort(-rates[:, anchor], kind="stable"))
    if classes == 3:
        second = int(np.argmax(means[:, 1 + features.index(third)]))
        order.remove(second)
        order.insert(1, second)
    return Priors(rates[order], weights[order] - weights[order[-1]], float(loglik), mass[order], means[order], done)


def shares(frame: DataFrame, fitted: Priors, features: list[str]) -> DataFrame:
    """frame with posterior, an array of each class's share of the row."""
    rates, weights = fitted.rates, fitted.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            bits = ((own("pattern")[:, None] >> np.arange(rates.shape[1])) & 1).astype(float)
            x = np.stack([np.ones(len(bits)), *(own(c).astype(float) for c in features)], 1)
            joint = x @ weights.T + bits @ (np.log(rates) - np.log1p(-rates)).T + np.log1p(-rates).sum(1)
            each = np.exp(joint - joint.max(1, keepdims=True))
            post = each / each.sum(1, keepdims=True)
            places = pa.array(np.arange(len(post) + 1) * post.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(places, pa.array(post.ravel()))], [*batch.schema.names, "posterior"])

    return frame.mapInArrow(run, StructType([*frame.schema.fields, StructField("posterior", ArrayType(DoubleType()))]))
