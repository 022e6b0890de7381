"""Latent-class models against closed forms, plain sums, finite differences and worlds with known parameters."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordlake.functions import words as fn
from wordlake.operators import mixtures, priors

EDGES = ((0, 1), (2, 3))


def world(spark, model, x, rows=1e7):
    """Cells with the counts that the model expects."""
    k = model.detectors
    y = mixtures.pattern_features(np.arange(1 << k), k, model.edges)
    w, c = model.states(x)
    joint = w + y @ c.T
    n = np.round(rows * np.exp(joint).sum(1)).astype(int)
    return mixtures.cells_table(spark, np.arange(1 << k), n, y), n


def one_class(model, x):
    """Probabilities of all cells in the first class alone."""
    y = mixtures.pattern_features(np.arange(1 << model.detectors), model.detectors, model.edges)
    w, c = model.states(x)
    first = len(w) // 2
    return np.exp(w[:first] + y @ c[:first].T).sum(1) / mixtures.logistic(x[:1])[0]


def test_loglinear_sums_to_one_and_reduces_to_independence():
    model = mixtures.LogLinear(5, EDGES)
    x = np.concatenate([[-1.0], [0.5, -0.2, 1.0, 0.0, -0.5], [0.7, -0.3], [0.1] * 5, [0.0, 0.0]])
    assert abs(one_class(model, x).sum() - 1) < 1e-12
    x[6:8] = 0
    p = mixtures.logistic(x[1:6])
    bits = mixtures.pattern_features(np.arange(32), 5)
    assert np.allclose(one_class(model, x), np.prod(np.where(bits == 1, p, 1 - p), 1), atol=1e-12)


def test_random_effects_closed_form_and_sum():
    model = mixtures.RandomEffects(5)
    a = np.array([0.5, -0.3, 1.0, -1.2, 0.0])
    x = np.concatenate([[-1.0], a, a - 1, np.zeros(5)])
    p = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in a])
    bits = mixtures.pattern_features(np.arange(32), 5)
    assert np.allclose(one_class(model, x), np.prod(np.where(bits == 1, p, 1 - p), 1), atol=1e-12)
    x[11:] = [0.8, 0.3, 1.2, 0.5, 0.9]
    assert abs(one_class(model, x).sum() - 1) < 1e-9
    assert np.allclose(model.rates(x)[0], [0.5 * math.erfc(-v / math.sqrt(2 * (1 + b * b))) for v, b in zip(a, x[11:])], atol=1e-8)  # the closed form of the marginal


@pytest.mark.parametrize("model", [mixtures.Independent(4), mixtures.LogLinear(4, EDGES), mixtures.RandomEffects(4, 9)])
def test_slopes_and_sums(spark, model):
    cells, n = world(spark, model, model.start("a"), 1e4)
    x = model.start("b")
    value = mixtures._goal(cells, model, float(n.sum()))
    goal, slope, loglik = value(x)
    y = mixtures.pattern_features(np.arange(16), 4, model.edges)
    w, c = model.states(x)
    assert math.isclose(loglik, float(n @ np.log(np.exp(w + y @ c.T).sum(1))), rel_tol=1e-12)
    (row,) = mixtures.log_likelihoods(cells, mixtures.states_table(spark, [model.states(x)])).collect()
    assert math.isclose(row["loglik"], loglik, rel_tol=1e-12)
    table = mixtures.states_table(spark, [(w, c)])
    (sums,) = mixtures.expected(cells, [(w, c)])
    for r in mixtures.expectations(cells, table, c.shape[1]).collect():
        assert math.isclose(r["mass"], sums.mass[r["state"]], rel_tol=1e-9) and np.allclose(r["fired"], sums.fired[r["state"]])
    for i in (0, 1, 5, model.size - 1):
        up, down = x.copy(), x.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert math.isclose((value(up)[0] - value(down)[0]) / 2e-5, slope[i], rel_tol=1e-4, abs_tol=1e-3)


def test_independent_recovery_orientation_posterior_and_checks(spark):
    model = mixtures.Independent(6)
    truth = mixtures.logit(np.array([0.3, 0.9, 0.7, 0.8, 0.85, 0.6, 0.75, 0.1, 0.2, 0.05, 0.15, 0.3, 0.1]))
    cells, _ = world(spark, model, truth)
    for seed in ("a", "b"):
        found = mixtures.fit(cells, model, seed, anchor=0)
        assert found.converged and np.abs(mixtures.logistic(found.x) - mixtures.logistic(truth)).max() < 1e-3
        rates = model.rates(found.x)
        assert rates[0, 0] > rates[1, 0]
    turned = mixtures.fit(cells, model, start=model.turned(truth), anchor=0)
    assert np.abs(mixtures.logistic(turned.x) - mixtures.logistic(truth)).max() < 1e-3
    post = {r["pattern"]: r["posterior"] for r in mixtures.posteriors(cells, model, found.x).collect()}
    assert post[63] > 0.99 and post[0] < 0.05
    row = mixtures.information(cells, model, found.x).first()
    assert (row["rank"], row["parameters"], row["identified"]) == (13, 13, True) and row["condition"] < 1e8
    drops = mixtures.profiles(cells, model, found, rounds=8).collect()
    assert len(drops) == 12 * 4 and all(r["identified"] and r["drop"] > 2 for r in drops if abs(r["step"]) == 0.05)
    starts, best = mixtures.multistart(cells, 6, starts=8, rounds=10, refined=2, anchor=0)
    starts = starts.collect()
    assert len(starts) == 8 and sum(r["refined"] for r in starts) == 2 and abs(best.goal - found.goal) < 0.1
    assert all(abs(r["share"] - 0.3) < 1e-3 for r in starts if r["refined"])


def test_two_detectors_are_not_identified(spark):
    model = mixtures.Independent(2)
    x = mixtures.logit(np.array([0.3, 0.9, 0.8, 0.1, 0.2]))
    cells, _ = world(spark, model, x)
    row = mixtures.information(cells, model, x).first()
    assert not row["identified"] or row["condition"] > 1e3


def test_loglinear_recovery(spark):
    model = mixtures.LogLinear(6, ((0, 1),))
    truth = np.concatenate([[-0.5], [1.5, 1.0, 1.2, 0.8, 1.4, 0.9], [0.8], [-2.0, -1.5, -1.8, -1.6, -2.2, -1.4], [0.5]])
    cells, _ = world(spark, model, truth, 1e8)
    found = mixtures.fit(cells, model, "a", anchor=1)
    assert np.abs(model.rates(found.x) - model.rates(truth)).max() < 0.01 and abs(mixtures.logistic(found.x[:1])[0] - mixtures.logistic(truth[:1])[0]) < 0.01
    assert abs(found.x[7] - 0.8) < 0.1


def test_random_effects_recovery(spark):
    model = mixtures.RandomEffects(6, 9)
    truth = np.concatenate([[-0.3], [1.5, 1.2, 1.0, 1.3, 0.9, 1.4], [-1.2, -1.5, -1.0, -1.4, -1.6, -1.1], [0.6, 0.5, 0.4, 0.7, 0.5, 0.6]])
    cells, _ = world(spark, model, truth, 1e8)
    found = mixtures.fit(cells, model, "a", anchor=1)
    assert np.abs(model.rates(found.x) - model.rates(truth)).max() < 0.01


def test_collapsed_and_odd_tables(spark):
    rows = spark.createDataFrame([(3,), (3,), (0,), (None,)], "pattern int")
    assert [(r["pattern"], r["n"]) for r in mixtures.collapsed(rows, 2).collect()] == [(0, 1), (3, 2)]
    assert [r["n"] for r in mixtures.collapsed(rows, 2, every=True).collect()] == [1, 0, 0, 2]
    with pytest.raises(ValueError):
        mixtures.collapsed(rows, 20)
    with pytest.raises(ValueError):
        mixtures.fit(mixtures.collapsed(rows.limit(0), 2, every=True), mixtures.Independent(2))


def three_classes(seed=1, n=6000):
    r = np.random.default_rng(seed)
    rates = np.array([[0.8, 0.9, 0.7, 0.85, 0.8], [0.1, 0.05, 0.1, 0.08, 0.05], [0.3, 0.25, 0.4, 0.3, 0.35]])
    out, own = [], []
    for _ in range(n):
        c = int(r.choice(3, p=[0.4, 0.3, 0.3]))
        scan = round(float(r.normal([0, 3, 0][c], 0.7)), 1)
        size = round(float(r.normal([1, 0, -1][c], 0.7)), 1)
        bits = r.random(5) < rates[c]
        out.append((int(bits @ (1 << np.arange(5))), scan, size if r.random() < 0.9 else None))
        own.append(c)
    return out, np.array(own), rates


def test_three_classes_with_features(spark):
    rows, own, rates = three_classes()
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, pattern int, scan double, size double")
    frame, names = priors.standardised(frame, ["scan", "size"])
    assert names == ["z_scan", "z_size", "miss_size"]
    first = frame.agg(F.avg("z_scan").alias("m"), F.stddev_pop("z_scan").alias("s"), F.sum("miss_size").alias("k")).first()
    assert abs(first["m"]) < 1e-9 and abs(first["s"] - 1) < 1e-9 and first["k"] == sum(r[2] is None for r in rows)
    found = priors.class_priors(frame, 5, names, 3, "z_scan")
    assert np.abs(found.rates - rates).max() < 0.06 and np.abs(found.mass / len(rows) - [0.4, 0.3, 0.3]).max() < 0.03
    post = {r["id"]: r["posterior"] for r in priors.shares(frame, found, names).select("id", "posterior").collect()}
    assert all(abs(sum(p) - 1) < 1e-9 for p in post.values())
    assert np.mean([int(np.argmax(post[i])) == own[i] for i in range(len(rows))]) > 0.9


def test_two_classes_match_the_independent_model_without_features(spark):
    model = mixtures.Independent(5)
    truth = mixtures.logit(np.array([0.4, 0.9, 0.8, 0.7, 0.8, 0.9, 0.1, 0.2, 0.1, 0.05, 0.1]))
    cells, n = world(spark, model, truth, 5000)
    frame = cells.select("pattern", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int")))).select("pattern")
    found = priors.class_priors(frame, 5, [], 2, rounds=200, tol=1e-12)
    assert np.abs(found.rates - model.rates(truth)).max() < 0.02 and abs(found.mass[0] / n.sum() - 0.4) < 0.02
    with pytest.raises(ValueError):
        priors.class_priors(frame, 5, [], 3)


def test_normal_functions(spark):
    xs = [-40.0, -9.0, -3.0, -2.0, -0.5, 0.0, 1e-9, 0.7, 2.0, 3.5, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(fn.normal_cdf(F.col("x")).alias("p"), fn.log_normal_cdf(F.col("x")).alias("l")).collect()
    for x, r in zip(xs, got):
        assert math.isclose(r["p"], 0.5 * math.erfc(-x / math.sqrt(2)), rel_tol=1e-12)
        assert math.isclose(r["l"], float(mixtures.log_normal_cdf(np.array([x]))[0]), rel_tol=1e-6, abs_tol=1e-15)
    ps = [1e-12, 0.001, 0.2, 0.5, 0.9, 1 - 1e-9, 0.0, 1.0]
    got = [r["x"] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(fn.normal_quantile(F.col("p")).alias("x")).collect()]
    assert got[-2:] == [None, None] and all(math.isclose(0.5 * math.erfc(-x / math.sqrt(2)), p, rel_tol=1e-9) for x, p in zip(got, ps[:-2]))
    assert all(a < b for a, b in itertools.pairwise(got[:-2]))


def test_features_of_words_are_made_once_from_attested_words(spark):
    from wordlake.functions import forms
    from wordlake.plans import features
    from wordlake.plans import mixtures as plans

    w = spark.createDataFrame([("schoolinaster", 1, 1), ("schoolmaster", 9, 3), ("rnodem", 2, 1), ("modem", 5, 4), ("mm", 3, 3), ("inm", 7, 2), ("dog", 8, 8)], "word string, n_tokens long, n_docs long")
    sources = w.select("word", "n_tokens", F.explode(forms.scan_sources(F.col("word"))).alias("neighbour"))
    want = sources.join(w.where("n_docs >= 3").select(F.col("word").alias("neighbour"), F.col("n_tokens").alias("m")), "neighbour").select("word", "n_tokens", "neighbour", "m")
    got = features.neighbours(w)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 2
    data = "/root/testdata/sf0.001"
    assert plans.features_table(spark, data).inputFiles() == plans.features_table(spark, data).inputFiles()  # though lambdas are numbered anew
    plan = plans._frame(spark, data)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan  # no round, pass or choice of models makes it again
