import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordlake.operators import classes, lists, priors, stats


def test_logistic_prior_is_found(spark):
    """A world of two classes whose odds grow with a feature."""
    draw = np.random.default_rng(5)
    x = draw.integers(-2, 3, 6000).astype(float)
    own = draw.random(6000) < 1 / (1 + np.exp(-(0.5 + 1.2 * x)))
    rates = np.where(own[:, None], 0.8, 0.15)
    patterns = ((draw.random((6000, 6)) < rates) << np.arange(6)).sum(1)
    frame = spark.createDataFrame(list(zip(patterns.tolist(), x.tolist())), "pattern int, x double")
    found = priors.class_priors(frame, 6, ["x"], 2)
    assert abs(found.weights[0, 0] - 0.5) < 0.2 and abs(found.weights[0, 1] - 1.2) < 0.2
    assert np.abs(found.rates - [[0.8] * 6, [0.15] * 6]).max() < 0.05
    with pytest.raises(ValueError):
        priors.class_priors(frame.where("false"), 6, ["x"], 2)


def test_em_step_is_that_of_numpy(spark):
    cells = spark.createDataFrame([(0, 5), (1, 7), (3, 2)], "pattern int, n long")
    bits, n = np.array([[0, 0], [1, 0], [1, 1]]), np.array([5, 7, 2])
    one, two = np.array([0.7, 0.6]), np.array([0.2, 0.3])
    a = 0.4 * np.prod(np.where(bits, one, 1 - one), 1)
    b = 0.6 * np.prod(np.where(bits, two, 1 - two), 1)
    mass = (n * a / (a + b)) @ bits
    got = {r["detector"]: r["mass"] for r in classes.em_step(cells, 0.4, one, two).collect()}
    assert np.allclose([got[0], got[1]], mass)


def test_log_upsert(spark):
    day = lambda d: datetime.date(2026, 1, d)
    old = lists.numbered_log(spark.createDataFrame([(day(1), 5), (day(3), 7)], "day date, n long"))
    new = spark.createDataFrame([(day(3), 9), (day(2), 4), (day(5), 1)], "day date, n long")
    assert sorted(map(tuple, lists.upsert_log(old, new).collect())) == [(day(1), 5, 1), (day(2), 4, 3), (day(3), 9, 2), (day(5), 1, 4)]
    assert sorted(map(tuple, lists.upsert_log(old.where("false"), new.where("n = 1")).collect())) == [(day(5), 1, 1)]


def test_digest_depends_on_rows_alone(spark):
    rows = [("a", 1), ("b", 2), ("c", 3)]
    of = lambda r, parts: stats.digest(spark.createDataFrame(r, "w string, n long").repartition(parts), "w", "n").first()
    assert of(rows, 1) == of(rows[::-1], 3) and of(rows, 1) != of([*rows[:2], ("c", 4)], 1)


def test_agreement_without_rows(spark):
    none = spark.range(0).select(F.lit(True).alias("a"), F.lit(True).alias("b"))
    assert stats.agreement(none, "a", "b").first()["kappa"] is None
