"""One round of a latent-class model as Spark aggregations: posteriors as columns, expected firings, products on edges."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit(pattern: Column, place: int) -> Column:
    return F.shiftright(pattern, place).bitwiseAND(1)


def log_odds(pattern: Column, first: Sequence[float], second: Sequence[float]) -> Column:
    """Log-likelihood of a pattern in the first class less that in the second, with independent detectors."""
    whole = F.lit(float(np.log1p(-np.asarray(first)).sum() - np.log1p(-np.asarray(second)).sum()))
    for j, (a, b) in enumerate(zip(first, second)):
        whole = whole + bit(pattern, j) * float(np.log(a / b) - np.log((1 - a) / (1 - b)))
    return whole


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-35.0)), F.lit(35.0))))


def em_step(cells: DataFrame, share: float, first: Sequence[float], second: Sequence[float]) -> DataFrame:
    """(detector, mass, rate) after one round on cells (pattern, n): expected firings in the first class, and its rates under Beta(2, 2)."""
    post = sigmoid(F.lit(float(np.log(share / (1 - share)))) + log_odds(F.col("pattern"), first, second))
    places = F.explode(F.array(*[F.struct(F.lit(j).alias("detector"), bit(F.col("pattern"), j).alias("fires")) for j in range(len(first))]))
    each = cells.select("n", post.alias("post"), places.alias("d")).select("n", "post", "d.*")
    mass = F.sum(F.col("n") * F.col("post") * F.col("fires"))
    return each.groupBy("detector").agg(mass.alias("mass"), ((mass + 1) / (F.sum(F.col("n") * F.col("post")) + 2)).alias("rate"))


def edge_counts(cells: DataFrame, edges: Sequence[tuple[int, int]]) -> DataFrame:
    """(j, k, n): rows in which both detectors of an edge fire, from cells (pattern, n)."""
    both = lambda j, k: F.col("pattern").bitwiseAND((1 << j) | (1 << k)) == ((1 << j) | (1 << k))
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(k).alias("k"), both(j, k).alias("fires")) for j, k in edges])).alias("e")
    return cells.select("n", each).groupBy("e.j", "e.k").agg(F.sum(F.when(F.col("e.fires"), F.col("n")).otherwise(0)).alias("n"))


def bic(sse: Column, n: int, parameters: int) -> Column:
    return n * F.log(sse / n) + parameters * float(np.log(n))
