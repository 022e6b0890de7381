"""Fitted models against plain versions in numpy and Python."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wordlake.operators import mixtures, models
from wordlake.plans.queries import QUERIES, evidence

DATA = "/root/testdata/sf0.001"


def frame(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def plain_shares(train, words):
    """Events as lists of shares, the slow way."""
    n = [Counter() for _ in range(4)]
    histories = [Counter() for _ in range(4)]
    walk = lambda w: [("^^^" + w + "$", j) for j in range(3, len(w) + 4)]
    for w in train:
        for p, j in walk(w):
            for k in range(4):
                n[k][p[j - k : j + 1]] += 1
                histories[k][p[j - k : j]] += 1
    return {(w, j + 1): [1 / 27] + [n[k][p[j - k : j + 1]] / histories[k][p[j - k : j]] if histories[k][p[j - k : j]] else None for k in range(4)] for w in words for p, j in walk(w)}


def test_char_model(spark):
    train, words = ["the", "then", "hat", "that"], ["the", "tan", "xo", ""]
    shares = models.char_shares(frame(spark, *words), models.char_table(frame(spark, *train)))
    want = plain_shares(train, words)
    got = {(r["word"], r["j"]): list(r["shares"]) for r in shares.collect()}
    assert got.keys() == want.keys()
    for key, share in want.items():
        assert all(a is b is None or math.isclose(a, b) for a, b in zip(got[key], share)), key

    weights = [0.2] * 5
    for _ in range(12):
        sums = np.zeros(5)
        for share in want.values():
            part = np.array([(x or 0) * w for x, w in zip(share, weights)])
            sums += part / part.sum()
        weights = list(sums / sums.sum())
    assert np.allclose(models.interpolation_weights(shares), weights)

    mix = lambda s: sum((x or 0) * w for x, w in zip(s, weights)) / sum(w for x, w in zip(s, weights) if x is not None)
    scores = {r["word"]: r["log10_p"] for r in models.word_scores(shares, weights).collect()}
    assert math.isclose(scores["tan"], sum(math.log10(mix(s)) for (w, _), s in want.items() if w == "tan"))
    assert math.isclose(sum(weights), 1)


def test_counted_events_give_the_weights_and_scores_of_single_ones(spark):
    train, words = ["the", "then", "hat", "that"], ["the", "tan", "xo", "", "tan", "tent"]
    model, held = models.char_table(frame(spark, *train)), frame(spark, *words).withColumn("long", F.length("word") > 2)
    single, counted = models.char_shares(held, model), models.kind_shares(held, model, "long")
    want = single.groupBy((F.length("word") > 2).alias("long"), "shares").agg(F.count("*").alias("n"))
    read = lambda df: sorted(((r["long"], r["n"], list(r["shares"])) for r in df.collect()), key=repr)
    assert read(counted.groupBy("long", "shares").agg(F.sum("n").alias("n"))) == read(want)
    assert np.allclose(models.interpolation_weights(single), models.interpolation_weights(models.kind_shares(held, model)))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert keys and not any("word#" in line.split("]")[0] for line in keys)  # no row per word and character is shuffled


def test_char_weights_of_nothing(spark):
    empty = frame(spark, "a").where("false")
    assert models.interpolation_weights(models.char_shares(empty, models.char_table(empty))) == [0.2] * 5


def test_latent_classes_recover_a_simulated_world(spark):
    rng = np.random.default_rng(5)
    good = rng.random(20000) < 0.3
    rates = np.array([[0.9, 0.8, 0.7, 0.85, 0.6], [0.1, 0.05, 0.2, 0.1, 0.15]])
    fires = rng.random((20000, 5)) < np.where(good[:, None], rates[0], rates[1])
    patterns = spark.createDataFrame([(int(x),) for x in fires @ (1 << np.arange(5))], "pattern int")
    cells, model = mixtures.collapsed(patterns, 5), mixtures.Independent(5)
    assert cells.count() <= 32 and mixtures.rows_of(cells) == 20000
    found = mixtures.fit(cells, model)
    assert abs(mixtures.logistic(found.x[:1])[0] - 0.3) < 0.02 and np.abs(model.rates(found.x) - rates).max() < 0.05
    scored = patterns.join(mixtures.posteriors(cells, model, found.x), "pattern")
    assert scored.count() == 20000 and abs(scored.agg(F.avg("posterior")).first()[0] - 0.3) < 0.02


def test_posterior_query_covers_every_word(spark):
    got = QUERIES["l10_latent_class"](spark, DATA).groupBy().agg(F.count("*"), F.min("posterior"), F.max("posterior")).first()
    assert got[0] == evidence(spark, DATA).count() and 0 <= got[1] <= got[2] <= 1
    split = QUERIES["f27_agreement"](spark, DATA).collect()
    assert sum(r["likely"] + r["unlikely"] for r in split) == got[0]


def test_rank_law_of_an_exact_law(spark):
    counts = spark.createDataFrame([(1000.0 / (r + 5) ** 1.5,) for r in range(1, 200)], "n_tokens double")
    best = models.rank_law(counts).orderBy("sse").first()
    assert (best["beta"], round(best["alpha"], 6), round(best["log_c"], 6)) == (5.0, 1.5, 3.0)
