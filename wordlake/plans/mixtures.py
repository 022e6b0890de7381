"""Registered queries over latent-class models: likelihoods at fixed parameters with SQL, fits, information, profiles and model choice."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import words as fn
from ..operators import mixtures, priors, stats
from ..sources.lexicon import table, words
from ..sources.store import stored
from .classes import _CELLS, DETECTORS, EDGES
from .features import most_frequent_neighbour
from .queries import evidence, on_tables, on_words

ANCHOR = 1
#: Parameters at which SQL repeats the likelihoods.
_THETA = [[0.5 - 0.1 * j for j in range(DETECTORS)], [-1.5 - 0.1 * j for j in range(DETECTORS)]]
_LAMBDA = [[0.3 - 0.05 * e for e in range(len(EDGES))], [0.1] * len(EDGES)]
_INTERCEPTS = [[0.6 - 0.1 * j for j in range(DETECTORS)], [-1 - 0.05 * j for j in range(DETECTORS)]]
_LOADINGS = [0.2 + 0.05 * j for j in range(DETECTORS)]
_SHARE = 0.2
_bit = lambda j: f"((pattern >> {j}) & 1)"
_FEATURES = [_bit(j) for j in range(DETECTORS)] + [f"({_bit(j)} * {_bit(k)})" for j, k in EDGES]
_score = lambda c: " + ".join(f"({v}) * {f}" for v, f in zip(_THETA[c] + _LAMBDA[c], _FEATURES))


def _cdf(x: str) -> str:
    """The standard normal distribution function by its power series, as SQL."""
    return f"(0.5 + exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()) * sign({x}) * coalesce(list_sum(list_transform(range(0, 150), lambda k: exp((2 * k + 1) * ln(abs({x})) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1)))), 0))"


def _cells(spark, sf_dir, edges=(), every=False) -> DataFrame:
    return mixtures.collapsed(evidence(spark, sf_dir), DETECTORS, edges, every)


def _shares(x: float) -> float:
    return math.log(x / (1 - x))


@on_words(
    "k50_normal",
    f", m as (select avg(length(word)) as m, stddev_pop(length(word)) as s from words), z as (select distinct length(word)::int as length, (length(word) - m) / s as x from words, m) select length, round({_cdf('x')}, 9) as cdf, round(ln({_cdf('-abs(x) / 2')}), 7) as log_tail, round(x, 6) as quantile from z",
)
def _(w):
    m = w.agg(F.avg(F.length("word")).alias("m"), F.stddev_pop(F.length("word")).alias("s"))  # one row
    z = w.select(F.length("word").alias("length")).distinct().join(F.broadcast(m), F.lit(True)).select("length", ((F.col("length") - F.col("m")) / F.col("s")).alias("x"))
    x = F.col("x")
    return z.select("length", F.round(fn.normal_cdf(x), 9).alias("cdf"), F.round(fn.log_normal_cdf(-F.abs(x) / 2), 7).alias("log_tail"), F.round(fn.normal_quantile(fn.normal_cdf(x)), 6).alias("quantile"))


def _sums_of(cells: DataFrame, model, x: np.ndarray) -> DataFrame:
    """(class, feature, loglik, mass, fired) of one parameter set; the states of a class are added up."""
    w, c = model.states(x)
    found = mixtures.expectations(cells, mixtures.states_table(cells.sparkSession, [(w, c)]), c.shape[1])
    half = len(w) // 2
    each = found.select(F.floor(F.col("state") / half).cast("int").alias("class"), "loglik", "mass", F.posexplode("fired").alias("feature", "fired"))
    return each.groupBy("class", "feature").agg(F.round(F.max("loglik"), 4).alias("loglik"), F.round(F.sum("mass"), 6).alias("mass"), F.round(F.sum("fired"), 6).alias("fired"))


@on_tables(
    "l11_likelihood",
    f"""{_CELLS}, z as (select ln(sum(exp({_score(0)}))) as z0, ln(sum(exp({_score(1)}))) as z1 from (select i::int as pattern from generate_series(0, {(1 << DETECTORS) - 1}) as t(i))),
j as (select pattern, n, ln({_SHARE}) + {_score(0)} - z0 as a, ln({1 - _SHARE}) + {_score(1)} - z1 as b from cells, z),
l as (select pattern, n, a, b, greatest(a, b) + ln(1 + exp(-abs(a - b))) as l from j),
y as (select n, l, unnest([exp(a - l), exp(b - l)]) as post, unnest([0, 1]) as class, [{', '.join(_FEATURES)}] as y from l)
select class::int as class, feature::int as feature, round((select sum(n * l) from l), 4) as loglik, round(sum(n * post), 6) as mass, round(sum(n * post * y[feature + 1]), 6) as fired
from y, range({len(_FEATURES)}) as f(feature) group by class, feature""",
)
def _(spark, sf_dir):
    model = mixtures.LogLinear(DETECTORS, EDGES)
    x = np.concatenate([[_shares(_SHARE)], _THETA[0], _LAMBDA[0], _THETA[1], _LAMBDA[1]])
    return _sums_of(_cells(spark, sf_dir, EDGES), model, x)


_RATES = ", ".join(f"({c}, {k}, {_INTERCEPTS[c][k]}, {_LOADINGS[k]})" for c in (0, 1) for k in range(DETECTORS))
_NODES = ", ".join(f"({q}, {u!r}, {v!r})" for q, (u, v) in enumerate(zip(*(a.tolist() for a in mixtures.quadrature()))))


@on_tables(
    "l12_likelihood",
    f"""{_CELLS}, d as (select *, {_cdf('x')} as p from (select c, k, q, weight, a + b * u as x from (values {_RATES}) as r(c, k, a, b), (values {_NODES}) as t(q, u, weight))),
s as (select pattern, n, c, q, any_value(ln(weight)) + any_value(case c when 0 then ln({_SHARE}) else ln({1 - _SHARE}) end) + sum(ln(case when (pattern >> k) & 1 = 1 then p else 1 - p end)) as j from cells, d group by pattern, n, c, q),
l as (select pattern, max(j) + ln(sum(exp(j - m))) as l from (select *, max(j) over (partition by pattern) as m from s) group by pattern, m),
post as (select s.pattern, s.n, c as class, sum(exp(j - l)) as post from s join l using (pattern) group by 1, 2, 3)
select class::int as class, feature::int as feature, round((select sum(n * l) from cells join l using (pattern)), 4) as loglik, round(sum(n * post), 6) as mass, round(sum(n * post * ((pattern >> feature::int) & 1)), 6) as fired
from post, range({DETECTORS}) as f(feature) group by class, feature""",
)
def _(spark, sf_dir):
    x = np.concatenate([[_shares(_SHARE)], *_INTERCEPTS, _LOADINGS])
    return _sums_of(_cells(spark, sf_dir), mixtures.RandomEffects(DETECTORS), x)


def _named(spark, fitted: mixtures.Fit, names: list[str], model) -> DataFrame:
    """(name, value): parameters, the share and marginal rates of both classes, and the log-likelihood."""
    rates = model.rates(fitted.x)
    rows = list(zip(names, map(float, fitted.x))) + [(f"{c}_{k}", float(v)) for c, r in zip(("first_rate", "second_rate"), rates) for k, v in enumerate(r)]
    rows += [("share", float(mixtures.logistic(fitted.x[:1])[0])), ("loglik", float(fitted.loglik)), ("converged", float(fitted.converged))]
    return spark.createDataFrame(rows, "name string, value double")


def _independent(spark, sf_dir) -> tuple[DataFrame, mixtures.Independent, mixtures.Fit]:
    cells, model = _cells(spark, sf_dir), mixtures.Independent(DETECTORS)
    return cells, model, mixtures.fit(cells, model, "s1", ANCHOR)


def _posterior(spark, sf_dir, *more: str) -> DataFrame:
    """(word, pattern, posterior) under the independent model, and more columns of words(); cells join back by broadcast, being at most 2**12."""
    cells, model, fitted = _independent(spark, sf_dir)
    return evidence(spark, sf_dir, *more).join(F.broadcast(mixtures.posteriors(cells, model, fitted.x)), "pattern")


@on_tables("l10_latent_class")
def _(spark, sf_dir):
    return _posterior(spark, sf_dir).select("word", "pattern", F.round("posterior", 6).alias("posterior"))


@on_tables("f27_agreement")
def _(spark, sf_dir):
    found = _posterior(spark, sf_dir, "n_docs")
    return found.groupBy((F.col("n_docs") >= 3).alias("listed")).agg(F.count_if(F.col("posterior") >= 0.5).alias("likely"), F.count_if(F.col("posterior") < 0.5).alias("unlikely"))


@on_tables("l11_loglinear")
def _(spark, sf_dir):
    model = mixtures.LogLinear(DETECTORS, EDGES)
    names = ["logit_share", *[f"{c}_{k}_{j}" for c in ("first", "second") for k, n in (("theta", DETECTORS), ("lambda", len(EDGES))) for j in range(n)]]
    return _named(spark, mixtures.fit(_cells(spark, sf_dir, EDGES), model, "s2", ANCHOR), names, model)


@on_tables("l12_random_effects")
def _(spark, sf_dir):
    model = mixtures.RandomEffects(DETECTORS)
    names = ["logit_share", *[f"{c}_{j}" for c in ("first", "second", "loading") for j in range(DETECTORS)]]
    return _named(spark, mixtures.fit(_cells(spark, sf_dir), model, "s3", ANCHOR), names, model)


@on_tables("l15_multistart")
def _(spark, sf_dir):
    return mixtures.multistart(_cells(spark, sf_dir), DETECTORS, anchor=ANCHOR)[0]


@on_tables("l16_information")
def _(spark, sf_dir):
    cells, model, fitted = _independent(spark, sf_dir)
    return mixtures.information(cells, model, fitted.x)


_STEP = 0.01
_FIXED = [_shares(0.5)] + [_shares(0.7)] * DETECTORS + [_shares(0.2)] * DETECTORS


@on_tables(
    "l16_slopes",
    f"""{_CELLS}, p as (select * from (values {', '.join(f'({i}, {v!r})' for i, v in enumerate(_FIXED))}) as t(m, x)),
s as (select i, sign, m, x + case when m = i then sign * {_STEP} else 0 end as x from p, range({len(_FIXED)}) as r(i), (values (-1), (1)) as g(sign)),
c as (select i, sign, class, any_value(w) as w, sum(-ln(1 + exp(x))) as base, list(x order by m) as x from (select *, (m > {DETECTORS})::int as class from s where m > 0) join (select i, sign, class, -ln(1 + exp(case class when 0 then -x else x end)) as w from s, range(2) as k(class) where m = 0) using (i, sign, class) group by i, sign, class),
j as (select i, sign, pattern, n, class, w + base + list_sum(list_transform(range(1, {DETECTORS + 1}), lambda k: x[k] * ((pattern >> (k - 1)::int) & 1))) as j from cells, c),
l as (select i, sign, sum(n * l) as l from (select i, sign, pattern, any_value(n) as n, max(j) + ln(1 + exp(min(j) - max(j))) as l from j group by i, sign, pattern) group by i, sign)
select i::int as parameter, round(sum(sign * l) / {2 * _STEP}, 3) as slope from l group by i""",
)
def _(spark, sf_dir):
    cells, model, x = _cells(spark, sf_dir), mixtures.Independent(DETECTORS), np.array(_FIXED)
    moved = [x + sign * _STEP * np.eye(len(x))[i] for i in range(len(x)) for sign in (-1, 1)]
    found = mixtures.log_likelihoods(cells, mixtures.states_table(spark, [model.states(at) for at in moved]))
    sign = F.when(F.col("set") % 2 == 0, -1).otherwise(1)
    return found.groupBy(F.floor(F.col("set") / 2).cast("int").alias("parameter")).agg(F.round(F.sum(sign * F.col("loglik")) / (2 * _STEP), 3).alias("slope"))


@on_tables("l17_profiles")
def _(spark, sf_dir):
    return mixtures.profiles(*_independent(spark, sf_dir))


def features_table(spark, sf_dir) -> DataFrame:
    """(word, pattern, length, vowels, scan), kept sorted by word: length, share of vowels, and how much more frequent the likeliest scanned word is, null without one."""

    def build() -> DataFrame:
        made = evidence(spark, sf_dir, "n_tokens").join(most_frequent_neighbour(words(spark, sf_dir)), "word", "left")
        scan = F.round(F.log10((F.col("m") + 1) / (F.col("n_tokens") + 1)), 1)
        return made.select("word", "pattern", F.length("word").alias("length"), F.round(fn.vowel_ratio(F.col("word")), 2).alias("vowels"), scan.alias("scan"))

    return stored(table(spark, sf_dir, "documents"), "features", build, "word")


def _frame(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """The features of features_table() standardised; scan is missing where no word may have been misread as this one."""
    return priors.standardised(features_table(spark, sf_dir), ["length", "vowels", "scan"])


def _weights(spark, fitted: priors.Priors, names: list[str]) -> DataFrame:
    kinds = ["first", "second", "third"][: len(fitted.rates)]
    rows = [(k, f"d{j}", float(v)) for k, r in zip(kinds, fitted.rates) for j, v in enumerate(r)]
    rows += [(k, n, float(v)) for k, w in zip(kinds, fitted.weights[:-1]) for n, v in zip(["constant", *names], w)]
    return spark.createDataFrame(rows, "class string, name string, value double")


@on_tables("l13_logistic_prior")
def _(spark, sf_dir):
    frame, names = _frame(spark, sf_dir)
    return _weights(spark, priors.class_priors(frame, DETECTORS, names, 2, anchor=ANCHOR), names)


@on_tables("l14_three_classes")
def _(spark, sf_dir):
    frame, names = _frame(spark, sf_dir)
    fitted = priors.class_priors(frame, DETECTORS, names, 3, "z_scan", ANCHOR)
    share = lambda c: F.round(F.col("posterior")[c], 6)
    return priors.shares(frame, fitted, names).select("word", share(0).alias("listed"), share(1).alias("scanned"), share(2).alias("neither"))


def _choice(spark, sf_dir) -> tuple[DataFrame, dict]:
    """(model, parameters, loglik, bic, converged, separated, passed, chosen) of all models, and the fits of the first three."""
    n = float(evidence(spark, sf_dir).count())
    made, rows = {}, []
    for name, model, edges in (("independent", mixtures.Independent(DETECTORS), ()), ("loglinear", mixtures.LogLinear(DETECTORS, EDGES), EDGES), ("random effects", mixtures.RandomEffects(DETECTORS), ())):
        cells = _cells(spark, sf_dir, edges)
        fitted = mixtures.fit(cells, model, name, ANCHOR)
        made[name] = (cells, model, fitted)
        rates = model.rates(fitted.x)
        rows.append((name, model.size, fitted.loglik, fitted.converged, bool(rates[0, ANCHOR] - rates[1, ANCHOR] > 0.01)))
    frame, names = _frame(spark, sf_dir)
    for name, classes in (("logistic prior", 2), ("three classes", 3)):
        fitted = priors.class_priors(frame, DETECTORS, names, classes, "z_scan" if classes == 3 else None, ANCHOR)
        rows.append((name, classes * DETECTORS + (classes - 1) * (1 + len(names)), fitted.loglik, fitted.rounds < 60, bool(fitted.rates[0, ANCHOR] - fitted.rates[-1, ANCHOR] > 0.01)))
    table = stats.chosen_model(spark.createDataFrame(rows, "model string, parameters int, loglik double, converged boolean, separated boolean"), n)
    return table, made


@on_tables("l21_model_choice")
def _(spark, sf_dir):
    return _choice(spark, sf_dir)[0].withColumn("loglik", F.round("loglik", 2)).withColumn("bic", F.round("bic", 2))


@on_tables("l22_posteriors")
def _(spark, sf_dir):
    """By stratum: rows, mean posterior, share above one half, quantiles, under the pattern model with the least BIC that passes its gates."""
    cells = _cells(spark, sf_dir)
    models = {"independent": (cells, mixtures.Independent(DETECTORS)), "random effects": (cells, mixtures.RandomEffects(DETECTORS)), "loglinear": (_cells(spark, sf_dir, EDGES), mixtures.LogLinear(DETECTORS, EDGES))}
    fits = {k: mixtures.fit(c, m, k, ANCHOR) for k, (c, m) in models.items()}
    n = mixtures.rows_of(cells)
    passed = {k: f for k, f in fits.items() if f.converged and np.subtract(*models[k][1].rates(f.x)[:, ANCHOR]) > 0.01} or fits
    best = min(passed, key=lambda k: -2 * fits[k].loglik + models[k][1].size * math.log(n))
    found = mixtures.posteriors(*models[best], fits[best].x)
    each = evidence(spark, sf_dir).join(F.broadcast(found), "pattern").join(words(spark, sf_dir).select("word", "intake"), "word")
    # posteriors are counted by stratum and cell first: at most 2**12 rows a stratum
    by = each.groupBy("intake", "posterior").agg(F.count("*").alias("n"))
    quantile = lambda q: F.round(F.percentile("posterior", q, F.col("n")), 6)
    return by.groupBy("intake").agg(
        F.lit(best).alias("model"), F.sum("n").alias("n"), F.round(F.sum(F.col("posterior") * F.col("n")) / F.sum("n"), 6).alias("mean"), F.round(F.sum(F.when(F.col("posterior") > 0.5, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("above_half"),
        *[quantile(q).alias(f"q{round(100 * q):02d}") for q in (0.05, 0.25, 0.5, 0.75, 0.95)],
    )
