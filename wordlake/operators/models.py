"""Models fitted on counts: character models, rank laws, capture and recapture.

The counts are Spark aggregations over all rows.  What reaches the driver is
bounded by the model's form, not by the data: a few sums per iteration for
interpolation weights, eight fits of a rank law.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Longest history of a character model; order k uses k characters before.
ORDERS = 4
#: Letters and the end mark.
ALPHABET = 27


# character models


def char_events(words: DataFrame, *keys: str) -> DataFrame:
    """(keys, j, c, h0 .. h3): each character of a padded word, its end included, after its histories; keys are columns of words, the word if none is given."""
    keys = keys or ("word",)
    padded = F.concat(F.lit("^" * (ORDERS - 1)), "word", F.lit("$"))
    at = words.select(*keys, padded.alias("p"), F.explode(F.sequence(F.lit(ORDERS), F.length("word") + ORDERS)).alias("j"))
    return at.select(*keys, "j", F.substr("p", "j", F.lit(1)).alias("c"), *[F.substr("p", F.col("j") - k, F.lit(k)).alias(f"h{k}") for k in range(ORDERS)])


def char_table(words: DataFrame) -> DataFrame:
    """(k, history, c, p): shares of characters after each history, every word counted once."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("history")) for k in range(ORDERS)])).alias("o")
    n = char_events(words).select("c", each).groupBy("o.k", "o.history", "c").agg(F.count("*").alias("n"))
    return n.select("k", "history", "c", (F.col("n") / F.sum("n").over(Window.partitionBy("k", "history"))).alias("p"))


def with_shares(kinds: DataFrame, model: DataFrame) -> DataFrame:
    """kinds, with c and h0 .. h3, and shares: what the uniform model and each order give; null where the history is unseen.

    A seen history that never had the character gives 0.  Histories of two and
    three characters are joined by sorting: their tables are of the alphabet's
    size, which is too much for copies in the driver and every executor.
    """
    seen = model.select("k", "history").distinct()
    for k in range(ORDERS):
        by = "merge" if k >= 2 else "broadcast"
        of = model.where(F.col("k") == k).select(F.col("history").alias(f"h{k}"), "c", F.col("p").alias("hit")).hint(by)
        known = seen.where(F.col("k") == k).select(F.col("history").alias(f"h{k}"), F.lit(0.0).alias("zero")).hint(by)
        kinds = kinds.join(of, [f"h{k}", "c"], "left").join(known, f"h{k}", "left").withColumn(f"p{k}", F.coalesce("hit", "zero")).drop("hit", "zero")
    shares = F.array(F.lit(1.0 / ALPHABET), *[F.col(f"p{k}") for k in range(ORDERS)])
    return kinds.withColumn("shares", shares).drop(*[f"p{k}" for k in range(ORDERS)])


def char_shares(words: DataFrame, model: DataFrame) -> DataFrame:
    """(word, j, shares): the shares of with_shares() for each event of a word.

    The events are joined as distinct (history, c) of the longest order, so that
    the join's size is that of the alphabet's n-grams and not of the text.
    """
    events = char_events(words)
    kinds = with_shares(events.select("c", *[f"h{k}" for k in range(ORDERS)]).distinct(), model)
    own = kinds.select(f"h{ORDERS - 1}", "c", "shares").hint("merge")
    return events.select("word", "j", "c", f"h{ORDERS - 1}").join(own, [f"h{ORDERS - 1}", "c"])


def kind_shares(words: DataFrame, model: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, shares): the events counted by keys, columns of words, and by histories and c; the alphabet and the keys bound the rows."""
    kind = [*keys, "c", *[f"h{k}" for k in range(ORDERS)]]
    counted = char_events(words.withColumn("__all", F.lit(0)), *(keys or ("__all",))).groupBy(*kind).agg(F.count("*").alias("n"))
    return with_shares(counted, model).select(*keys, "n", "shares")


def mixed(shares: Column, weights: list[float]) -> Column:
    """The weighted share, the weights of unseen histories dealt to the others."""
    both = F.zip_with(shares, F.array(*map(F.lit, weights)), lambda p, w: F.struct((p * w).alias("pw"), F.when(p.isNotNull(), w).otherwise(0.0).alias("w")))
    total = lambda name: F.aggregate(both, F.lit(0.0), lambda s, x: s + F.coalesce(x[name], F.lit(0.0)))
    return total("pw") / total("w")


def interpolation_weights(shares: DataFrame, rounds: int = 12) -> list[float]:
    """EM for the weights of the orders, from equal ones; shares needs a column shares, and may have n, by which a row counts.

    The distinct tuples of shares are counted once and cached (lost parts are computed again);
    each round is one aggregation over them that returns five sums.
    """
    tuples = shares.groupBy("shares").agg((F.sum("n") if "n" in shares.columns else F.count("*")).alias("n")).cache()
    weights = [1 / (ORDERS + 1)] * (ORDERS + 1)
    try:
        for _ in range(rounds):
            parts = [F.coalesce(F.col("shares")[k], F.lit(0.0)) * weights[k] for k in range(ORDERS + 1)]
            whole = sum(parts[1:], parts[0])
            sums = tuples.agg(*[F.sum(F.col("n") * p / whole).alias(f"s{k}") for k, p in enumerate(parts)]).first()
            got = np.array([x or 0.0 for x in sums])
            if not got.sum():
                break
            weights = [float(x) for x in got / got.sum()]
    finally:
        tuples.unpersist()
    return weights


def word_scores(shares: DataFrame, weights: list[float], floor: float = 1e-12) -> DataFrame:
    """(word, log10_p, per_char): a word's probability, its end included."""
    p = F.log10(F.greatest(mixed(F.col("shares"), weights), F.lit(floor)))
    return shares.groupBy("word").agg(F.sum(p).alias("log10_p"), F.avg(p).alias("per_char"))


#: The characters in the order in which cumulative shares add them up, the end mark last; letters of a sampled word at most.
CHARACTERS = "abcdefghijklmnopqrstuvwxyz$"
LONGEST_SAMPLE = 24


def next_characters(model: DataFrame, weights: list[float]) -> DataFrame:
    """(h3, cumulative): for every history of the longest order the cumulative mixed shares of CHARACTERS; the alphabet bounds the rows (18,279)."""
    letters = F.explode(F.split(F.lit(CHARACTERS[:-1]), "")).alias("x")
    histories = model.sparkSession.range(1).select(F.lit("^" * (ORDERS - 1)).alias("h3"))
    grown = histories
    for _ in range(ORDERS - 1):
        grown = grown.select("h3", letters).select(F.concat(F.substring("h3", 2, ORDERS - 2), "x").alias("h3"))
        histories = histories.unionByName(grown)
    kinds = histories.select("h3", F.posexplode(F.split(F.lit(CHARACTERS), "")).alias("place", "c"))
    of = {k: F.right("h3", F.lit(k)) if k else F.lit("") for k in range(ORDERS)}
    kinds = kinds.select("*", *[of[k].alias(f"__h{k}") for k in range(ORDERS)])
    seen = model.select("k", "history").distinct()
    for k in range(ORDERS):
        hit = model.where(F.col("k") == k).select(F.col("history").alias(f"__h{k}"), "c", F.col("p").alias("hit"))
        known = seen.where(F.col("k") == k).select(F.col("history").alias(f"__h{k}"), F.lit(0.0).alias("zero"))
        kinds = kinds.join(hit, [f"__h{k}", "c"], "left").join(known, f"__h{k}", "left").withColumn(f"p{k}", F.coalesce("hit", "zero")).drop("hit", "zero")
    share = mixed(F.array(F.lit(1.0 / ALPHABET), *[F.col(f"p{k}") for k in range(ORDERS)]), weights)
    own = Window.partitionBy("h3").orderBy("place")
    by = kinds.select("h3", "place", F.sum(share).over(own).alias("upto"))
    return by.groupBy("h3").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "upto"))), lambda x: x["upto"]).alias("cumulative"))


def sample_words(tags: DataFrame, model: DataFrame, weights: list[float], unit, longest: int = LONGEST_SAMPLE) -> DataFrame:
    """(tag, word): a word drawn from the model for each tag; unit(tag, i) gives the i-th number in [0, 1) of a tag, so draws repeat.

    A round adds a character to all words that have not ended: the history's
    cumulative shares, broadcast, are searched for the word's number.  Rounds
    are chained in one stage, without a shuffle.
    """
    table = tags.sparkSession.createDataFrame(next_characters(model, weights).toArrow())  # of the alphabet's size, and made once
    state = tags.select("tag", F.lit("").alias("word"), F.lit("^" * (ORDERS - 1)).alias("h3"))
    for i in range(longest):
        # within a transform, so that the number is made once and not for each character
        below = F.transform(F.array(unit(F.col("tag"), F.lit(i))), lambda u: F.size(F.filter("cumulative", lambda x: x < u)))[0]
        place = F.least(below, F.lit(ALPHABET - 1)) + 1
        c = F.substr(F.lit(CHARACTERS), place, F.lit(1))
        state = state.join(F.broadcast(table), "h3", "left").withColumn("c", F.when(F.col("h3").isNull(), "$").otherwise(c))
        ended = F.col("c") == "$"
        state = state.select("tag", F.when(ended, F.col("word")).otherwise(F.concat("word", "c")).alias("word"), F.when(~ended, F.concat(F.substring("h3", 2, ORDERS - 2), "c")).alias("h3"))
    return state.select("tag", "word")


# rank laws and capture-recapture


#: The shifts of rank that are tried.
BETAS = (0.0, 1.0, 2.7, 5.0, 10.0, 26.0, 100.0, 1000.0)
PROBES = 400


def ranks(counts: DataFrame, count: str = "n_tokens") -> DataFrame:
    """(count, k, rank) of each distinct count: how many have it, and one more than have a larger one."""
    by = counts.groupBy(count).agg(F.count("*").alias("k"))
    above = F.coalesce(F.sum("k").over(Window.orderBy(F.desc(count)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return by.select(count, "k", (above + 1).alias("rank"))


def rank_law(counts: DataFrame, betas: tuple[float, ...] = BETAS, count: str = "n_tokens") -> DataFrame:
    """(beta, alpha, log_c, sse): least squares of log10 count on log10(rank + beta), over PROBES ranks at equal ratios.

    Ranks are found among the distinct counts, which grow far slower than the rows.
    """
    by = ranks(counts, count)
    i = F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))).alias("i")
    probes = by.agg(F.sum("k").alias("size")).select("size", i).select(F.floor(F.pow("size", F.col("i") / F.lit(float(PROBES - 1)))).alias("at")).distinct()
    probed = by.join(F.broadcast(probes), (F.col("at") >= F.col("rank")) & (F.col("at") < F.col("rank") + F.col("k")))  # PROBES rows at most
    each = probed.select(F.log10(count).alias("y"), "at", F.explode(F.array(*[F.lit(float(b)) for b in betas])).alias("beta"))
    each = each.withColumn("x", F.log10(F.col("at") + F.col("beta")))
    fit = each.groupBy("beta").agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("log_c"), F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"))
    return fit.select("beta", (-F.col("slope")).alias("alpha"), "log_c", (F.col("syy") - F.col("slope") * F.col("sxy")).alias("sse"))


def recapture(patterns: DataFrame, first: int, second: int) -> DataFrame:
    """One row (only_first, only_second, both, estimate): Chapman's estimate from two groups of detectors, given as bit masks."""
    a, b = (F.col("pattern").bitwiseAND(m) > 0 for m in (first, second))
    sums = patterns.agg(F.count_if(a & ~b).alias("only_first"), F.count_if(b & ~a).alias("only_second"), F.count_if(a & b).alias("both"))
    n1, n2 = F.col("only_first") + F.col("both"), F.col("only_second") + F.col("both")
    return sums.withColumn("estimate", (n1 + 1) * (n2 + 1) / (F.col("both") + 1) - 1)


def stratified_error(tallies: DataFrame) -> DataFrame:
    """One row (estimate, se) from strata (size, n, k), with finite population correction; strata without trials are left out."""
    used = tallies.where("n > 0")
    p, size, n = F.col("k") / F.col("n"), F.col("size"), F.col("n")
    spread = F.when(n > 1, p * (1 - p) / (n - 1) * (1 - n / size)).otherwise(0.0)
    return used.agg((F.sum(size * p) / F.sum(size)).alias("estimate"), (F.sqrt(F.sum(size * size * spread)) / F.sum(size)).alias("se"))
