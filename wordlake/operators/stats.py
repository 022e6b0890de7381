"""Rates, ranks, intervals and samples over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Ranges of scores within each of which ranks are running sums.
RANGES = 256


def auc(scored: DataFrame, group: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Mann-Whitney AUC per group with average ranks for ties.

    Ranks come from counts per distinct score.  A group's scores are cut into
    ranges at approximate quantiles: running sums go within a range and over the
    ranges' totals, so a group of very many distinct scores is no task's.
    """
    by = scored.groupBy(*group, score).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("int")).alias("k"))
    edges = by.groupBy(*group).agg(F.percentile_approx(score, [i / RANGES for i in range(1, RANGES)], 10_000).alias("__edges"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"b.{g}").eqNullSafe(F.col(f"e.{g}"))
    place = F.size(F.filter("__edges", lambda e: e < F.col(score)))
    by = by.alias("b").join(edges.alias("e"), same).select("b.*", place.alias("__range"))
    ranges = by.groupBy(*group, "__range").agg(F.sum("n").alias("__all"))
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows a group
    ranges = ranges.withColumn("__ahead", F.coalesce(F.sum("__all").over(earlier), F.lit(0))).drop("__all")
    same = F.col("b.__range") == F.col("r.__range")
    for g in group:
        same = same & F.col(f"b.{g}").eqNullSafe(F.col(f"r.{g}"))
    by = by.alias("b").join(ranges.alias("r"), same).select("b.*", "r.__ahead")
    within = F.coalesce(F.sum("n").over(Window.partitionBy(*group, "__range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by = by.withColumn("rank", F.col("__ahead") + within + (F.col("n") + 1) / 2)
    sums = by.groupBy(*group).agg(F.sum("k").alias("positives"), (F.sum("n") - F.sum("k")).alias("negatives"), F.sum(F.col("rank") * F.col("k")).alias("ranks"))
    area = (F.col("ranks") - F.col("positives") * (F.col("positives") + 1) / 2) / (F.col("positives") * F.col("negatives"))
    return sums.select(*group, "positives", "negatives", F.when(F.least("positives", "negatives") >= 10, area).alias("auc"))


def draw(frame: DataFrame, seed: str, stratum: str, key: str, sizes: dict[str, int]) -> DataFrame:
    """hash_sample() of so many rows of each stratum; a stratum that is missing or has fewer rows is an error, not a smaller sample."""
    held = {r[stratum]: r["n"] for r in frame.where(F.col(stratum).isin(list(sizes))).groupBy(stratum).agg(F.count("*").alias("n")).collect()}
    short = {s: (held.get(s, 0), n) for s, n in sizes.items() if held.get(s, 0) < n}
    if short:
        raise ValueError(f"cannot draw from strata with fewer rows (has, wanted): {short}")
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col(stratum)]
    picked = hash_sample(frame.where(F.col(stratum).isin(list(sizes))), seed, stratum, key, max(sizes.values(), default=0))
    return picked.where(F.col("position") <= wanted)


def hash_sample(frame: DataFrame, seed: str, stratum: str, key: str, n: int) -> DataFrame:
    """The n rows of each stratum whose SHA-256 of seed:stratum:key is least, with the first 16 hex digits of it."""
    rank = F.sha2(F.concat_ws(":", F.lit(seed), F.col(stratum), F.col(key)), 256)
    order = Window.partitionBy(stratum).orderBy("full_rank", key)
    picked = frame.withColumn("full_rank", rank).withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
    return picked.withColumn("rank_key", F.substring("full_rank", 1, 16)).drop("full_rank", "position")


def running(total: Column, *order: Column) -> Column:
    """Cumulative sum over a small, aggregated table."""
    return F.sum(total).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def growth(log: DataFrame) -> DataFrame:
    """One row on a log (day, raw), one row a day: days with and without a recorded total, the first and last total, and the changes between recorded days.

    What is no plain number is not recorded, and never counts as zero.
    """
    total = F.when(F.col("raw").rlike(r"^\d+\z"), F.col("raw").cast("long"))
    known = F.col("total").isNotNull()
    every = log.select("day", total.alias("total"))
    before = F.last("total", ignorenulls=True).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    every = every.withColumn("delta", F.when(known, F.col("total") - before))
    return every.agg(
        F.min(F.when(known, F.col("day"))).cast("string").alias("recorded_from"), F.max(F.when(known, F.col("day"))).cast("string").alias("recorded_to"), F.count("total").alias("days_recorded"),
        F.count_if(~known).alias("days_unrecorded"), F.min_by("total", F.when(known, F.col("day"))).alias("first"), F.max_by("total", F.when(known, F.col("day"))).alias("last"), F.count_if(F.col("delta") != 0).alias("events"),
    )


def auc_interval(area: Column, positives: Column, negatives: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds by the Hanley-McNeil standard error."""
    one, two = area / (2 - area), 2 * area * area / (1 + area)
    spread = (area * (1 - area) + (positives - 1) * (one - area * area) + (negatives - 1) * (two - area * area)) / (positives * negatives)
    se = F.sqrt(F.greatest(spread, F.lit(1e-12)))
    return area - z * se, area + z * se


def deciles(scores: DataFrame, column: str) -> DataFrame:
    """(bin, low, high, n): ten bins between the exact deciles, half open but for the last.

    Edges and bins come from the counts of the distinct scores.
    """
    by = scores.groupBy(column).agg(F.count("*").alias("k"))
    edges = by.agg(F.percentile(column, F.array(*[F.lit(i / 10) for i in range(11)]), F.col("k")).alias("edges"))  # one row
    bins = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("bin")
    table = edges.select("edges", bins).select("bin", F.element_at("edges", F.col("bin")).alias("low"), F.element_at("edges", F.col("bin") + 1).alias("high"))
    x = F.col(column)
    inside = (x >= F.col("low")) & ((x < F.col("high")) | ((F.col("bin") == 10) & (x == F.col("high"))))
    filled = by.join(F.broadcast(table), inside).groupBy("bin").agg(F.sum("k").alias("n"))  # ten rows
    return table.join(filled, "bin", "left").select("bin", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def row_index(keys: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """(column, index): the place of each distinct key in sorted order, by counts per first letters and numbers within them, without a global sort."""
    keys = keys.withColumn("head", F.left(F.col(column), F.lit(digits)))
    heads = keys.groupBy("head").agg(F.count("*").alias("n"))  # a row for each beginning
    before = F.coalesce(F.sum("n").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = keys.withColumn("place", F.row_number().over(Window.partitionBy("head").orderBy(column)) - 1)
    return own.join(heads.select("head", before.alias("before")), "head").select(column, (F.col("before") + F.col("place")).alias("index"))


def tripwires(metrics: DataFrame, bounds: dict[str, tuple[str, float | None, float | None]]) -> DataFrame:
    """(metric, value, tripped) of a row of metrics against bounds (column, least, most), all of them at once."""
    out = lambda c, low, high: (F.lit(False) if low is None else F.col(c) < low) | (F.lit(False) if high is None else F.col(c) > high)
    each = [F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"), out(c, low, high).alias("tripped")) for name, (c, low, high) in bounds.items()]
    return metrics.select(F.explode(F.array(*each)).alias("m")).select("m.*")


def digest(rows: DataFrame, *columns: str, digits: int = 3) -> DataFrame:
    """One row (digest, n): a hash of all rows that does not depend on their order; rows are dealt by the first hex digits of their own hash."""
    each = rows.select(F.sha2(F.concat_ws(":", *columns), 256).alias("h"))
    parts = each.groupBy(F.substring("h", 1, digits).alias("part")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("d"), F.count("*").alias("n"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("part", "d"))), lambda x: x["d"])  # 16 ** digits at most
    return parts.agg(F.sha2(F.array_join(ordered, ""), 256).alias("digest"), F.sum("n").alias("n"))


def reliability(scored: DataFrame, p: str, label: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean, rate, error_part) of equal bins of a probability; the parts add up to the expected calibration error."""
    place = F.least(F.lit(bins - 1), F.floor(F.col(p) * bins)).cast("int")
    by = scored.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean"), (F.count_if(F.col(label)) / F.count("*")).alias("rate"))
    part = F.col("n") / F.sum("n").over(Window.partitionBy()) * F.abs(F.col("mean") - F.col("rate"))  # over the bins
    return by.select("bin", "n", F.round("mean", 9).alias("mean"), F.round("rate", 9).alias("rate"), F.round(part, 9).alias("error_part"))


def agreement(pairs: DataFrame, test: str, truth: str) -> DataFrame:
    """One row (n, kappa, sensitivity, specificity, prevalence) of a test against the truth; prevalence is corrected by Rogan and Gladen's rule."""
    a, b = F.col(test), F.col(truth)
    s = pairs.agg(F.count("*").alias("n"), F.count_if(a & b).alias("tp"), F.count_if(a & ~b).alias("fp"), F.count_if(b & ~a).alias("fn"), F.count_if(~a & ~b).alias("tn"))
    over = lambda x, y: F.try_divide(x, y)
    n, tp, fp, fn, tn = map(F.col, ("n", "tp", "fp", "fn", "tn"))
    chance = over(tp + fp, n) * over(tp + fn, n) + over(fn + tn, n) * over(fp + tn, n)
    sensitivity, specificity = over(tp, tp + fn), over(tn, tn + fp)
    prevalence = over(over(tp + fp, n) + specificity - 1, sensitivity + specificity - 1)
    return s.select("n", F.round(over(over(tp + tn, n) - chance, 1 - chance), 9).alias("kappa"), F.round(sensitivity, 9).alias("sensitivity"), F.round(specificity, 9).alias("specificity"), F.round(prevalence, 9).alias("prevalence"))


def chosen_model(fits: DataFrame, rows: float) -> DataFrame:
    """fits (model, parameters, loglik, and boolean gates) with bic, passed and chosen: the least BIC among those that pass all gates, ties by name.

    fits has a row a model; no model is chosen where none passes.
    """
    gates = [c for c, kind in fits.dtypes if kind == "boolean"]
    passed = F.lit(True)
    for g in gates:
        passed = passed & F.coalesce(F.col(g), F.lit(False))
    judged = fits.withColumn("bic", -2 * F.col("loglik") + F.col("parameters") * F.log(F.lit(float(rows)))).withColumn("passed", passed)
    place = F.row_number().over(Window.orderBy(F.desc("passed"), "bic", "model"))
    return judged.withColumn("chosen", F.col("passed") & (place == 1))


def allocation(buckets: DataFrame, target: int, cap: str = "n") -> DataFrame:
    """buckets (bucket, n, and cap) with goal: target dealt in proportion to n, by largest remainders, no bucket getting more than its cap.

    What caps leave over goes round the buckets in order, one each, as long as
    any has room.  Rounds are not made: how many are full follows from sums over
    the buckets' room.  buckets has a row a bucket, so windows over all are small;
    ties go by bucket, and where all room is used the goals stay below the target.
    """
    every = Window.partitionBy()
    exact = F.col("n") * target / F.sum("n").over(every)
    whole = F.least(F.col(cap), F.floor(exact)).cast("long")
    b = buckets.withColumn("__exact", exact).withColumn("__whole", whole)
    b = b.withColumn("__left", target - F.sum("__whole").over(every)).withColumn("__room", F.col(cap) > F.col("__whole"))
    order = Window.partitionBy("__room").orderBy(F.desc(F.col("__exact") - F.col("__whole")), "bucket")
    b = b.withColumn("__one", (F.col("__room") & (F.row_number().over(order) <= F.col("__left"))).cast("long"))
    b = b.withColumn("__left", F.col("__left") - F.sum("__one").over(every)).withColumn("__space", F.col(cap) - F.col("__whole") - F.col("__one"))
    # r full rounds give each bucket min(space, r): buckets of little space first
    up = Window.orderBy("__space", "bucket")
    b = b.withColumn("__given", F.coalesce(F.sum("__space").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("__more", F.count("*").over(every) - F.row_number().over(up) + 1)
    # the first bucket that is not filled by the rounds that are left to it and those after it tells their number
    b = b.withColumn("__fits", F.floor((F.col("__left") - F.col("__given")) / F.col("__more"))).withColumn("__at", F.row_number().over(up))
    rounds = F.coalesce(F.min(F.when(F.col("__fits") < F.col("__space"), F.struct("__at", "__fits"))).over(every)["__fits"], F.max("__space").over(every))
    b = b.withColumn("__rounds", rounds).withColumn("__full", F.least(F.col("__space"), F.col("__rounds")))
    b = b.withColumn("__left", F.col("__left") - F.sum("__full").over(every)).withColumn("__again", F.col("__space") > F.col("__full"))
    last = F.row_number().over(Window.partitionBy("__again").orderBy("bucket"))
    extra = (F.col("__again") & (last <= F.col("__left"))).cast("long")
    return b.select(*buckets.columns, (F.col("__whole") + F.col("__one") + F.col("__full") + extra).alias("goal"))


def best_of_buckets(scored: DataFrame, goals: DataFrame, bucket: str, score: str, tie: str, key: str) -> DataFrame:
    """The rows of scored that are among the goal best of their bucket: highest score, then least tie, then key; goals (bucket, goal) has a row a bucket."""
    own = scored.join(F.broadcast(goals.select(F.col("bucket").alias(bucket), "goal")), bucket)
    return own.withColumn("rank", F.row_number().over(Window.partitionBy(bucket).orderBy(F.desc(score), tie, key))).where(F.col("rank") <= F.col("goal")).drop("goal")
