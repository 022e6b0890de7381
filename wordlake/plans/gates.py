"""Registered queries that hold features and models against control families and known parameters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import mixtures, stats
from ..sources.lexicon import WORDS_SQL, words
from .mixtures import ANCHOR, DETECTORS
from .queries import _PATTERN, evidence, on_tables

#: Words of one document alone, which nothing confirms, and rare words that are attested.
_FAMILIES = """, single as (select word from words where n_docs = 1),
cut as (select quantile_disc(n_tokens, 0.25) as q from words where n_docs >= 3),
family as (select word, 'single' as family from single union all select word, 'rare' from words, cut where n_docs >= 3 and n_tokens <= q)"""
_GATE_FEATURES = {"n_tokens": "n_tokens", "n_docs": "n_docs", "tokens_per_doc": "n_tokens / n_docs", "length": "length(word)"}


def _families(w):
    """w with family: words of one document, and attested words of the lowest quarter of counts; no word is both, others go."""
    # the quarter from counts of counts
    counts = w.where("n_docs >= 3").groupBy("n_tokens").agg(F.count("*").alias("k"))
    sums = counts.withColumn("upto", stats.running(F.col("k"), F.col("n_tokens"))).join(F.broadcast(counts.agg(F.sum("k").alias("all"))), F.lit(True))
    q = sums.where("upto >= ceil(0.25 * all)").agg(F.min("n_tokens").alias("q"))  # one row
    family = F.when(F.col("n_docs") == 1, "single").when((F.col("n_docs") >= 3) & (F.col("n_tokens") <= F.col("q")), "rare")
    return w.join(F.broadcast(q), F.lit(True)).withColumn("family", family).where("family is not null").drop("q")


@on_tables(
    "l24_rare_gate",
    f"""with {WORDS_SQL}{_FAMILIES}, g as ({' union all '.join(f"select '{n}' as feature, (family = 'rare')::int as y, ({x})::double as score from family join words using (word)" for n, x in _GATE_FEATURES.items())}),
s as (select feature, y, rank() over (partition by feature order by score) + (count(*) over (partition by feature, score) - 1) / 2 as r from g),
a as (select feature, sum(y)::double as p, sum(1 - y)::double as q, (sum(r * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) as auc from s group by feature having least(sum(y), sum(1 - y)) >= 10),
e as (select *, sqrt(greatest((auc * (1 - auc) + (p - 1) * (auc / (2 - auc) - auc * auc) + (q - 1) * (2 * auc * auc / (1 + auc) - auc * auc)) / (p * q), 1e-12)) as se from a)
select feature, p::bigint as positives, q::bigint as negatives, round(auc, 9) as auc, round(auc - 1.96 * se, 9) as low, round(auc + 1.96 * se, 9) as high, auc - 1.96 * se <= 0.5 and auc + 1.96 * se >= 0.5 as undecided, bool_and(auc - 1.96 * se <= 0.5 and auc + 1.96 * se >= 0.5) over () as fires from e""",
)
def _(spark, sf_dir):
    each = _families(words(spark, sf_dir))
    score = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.expr(x).cast("double").alias("score")) for n, x in _GATE_FEATURES.items()])).alias("x")
    found = stats.auc(each.select((F.col("family") == "rare").alias("label"), score).select("label", "x.*"), ["feature"]).where("auc is not null")
    low, high = stats.auc_interval(F.col("auc"), F.col("positives"), F.col("negatives"))
    found = found.withColumn("low", low).withColumn("high", high).withColumn("undecided", (F.col("low") <= 0.5) & (F.col("high") >= 0.5))
    fires = found.agg(F.bool_and("undecided").alias("fires"))  # one row; there are a few features
    found = found.join(F.broadcast(fires), F.lit(True))
    return found.select("feature", "positives", "negatives", *[F.round(c, 9).alias(c) for c in ("auc", "low", "high")], "undecided", "fires")


@on_tables(
    "l24_firing_rates",
    f"with {WORDS_SQL}, {_PATTERN}{_FAMILIES} select family, d::int as detector, count(*) as n, round(avg((pattern >> d::int) & 1), 9) as rate from family join evidence using (word), range({DETECTORS}) as r(d) group by family, d",
)
def _(spark, sf_dir):
    own = _families(evidence(spark, sf_dir, "n_docs", "n_tokens")).groupBy("family", "pattern").agg(F.count("*").alias("n"))
    bits = F.explode(F.array(*[F.struct(F.lit(d).alias("detector"), F.shiftright("pattern", d).bitwiseAND(1).alias("fires")) for d in range(DETECTORS)])).alias("b")
    each = own.select("family", "n", bits).select("family", "n", "b.*").groupBy("family", "detector")
    return each.agg(F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("fires")) / F.sum("n"), 9).alias("rate"))


@on_tables("f44_fitted_error")
def _(spark, sf_dir):
    """(error, within): how far the rates of a fit are from those that its rows were made with, as many rows as there are words."""
    rows, model = evidence(spark, sf_dir).count(), mixtures.Independent(DETECTORS)
    truth = mixtures.logit(np.concatenate([[0.3], np.linspace(0.9, 0.55, DETECTORS), np.linspace(0.05, 0.25, DETECTORS)]))
    y = mixtures.pattern_features(np.arange(1 << DETECTORS), DETECTORS)
    w, c = model.states(truth)
    n = np.round(rows * np.exp(w + y @ c.T).sum(1)).astype(np.int64)
    fitted = mixtures.fit(mixtures.cells_table(spark, np.arange(1 << DETECTORS), n, y), model, "truth", ANCHOR)
    error = float(np.abs(mixtures.logistic(fitted.x) - mixtures.logistic(truth)).max())
    return spark.createDataFrame([(round(error, 6), error <= 0.05)], "error double, within boolean")
