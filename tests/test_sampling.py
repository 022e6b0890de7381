"""Words drawn from the character model, against plain draws."""

import hashlib

import pytest
from pyspark.sql import functions as F

from wordlake.functions import words as fn
from wordlake.operators import models

WEIGHTS = [0.01, 0.04, 0.15, 0.3, 0.5]
TRAIN = ["the", "then", "that", "hat", "hot", "tot", "noon"]


def share(h, c):
    """The mixed share of c after the padded history h."""
    above = below = 0.0
    for k in range(-1, 4):
        w = WEIGHTS[k + 1]
        if k < 0:
            above, below = above + w / 27, below + w
            continue
        of = h[len(h) - k :]
        seen = [(p[j - k : j], p[j]) for p in ("^^^" + x + "$" for x in TRAIN) for j in range(3, len(p))]
        after = [x for g, x in seen if g == of]
        if after:
            above, below = above + w * after.count(c) / len(after), below + w
    return above / below


def drawn(tag, longest):
    h, out = "^^^", ""
    while len(out) < longest:
        u = int(hashlib.sha256(f"s:{tag}:{len(out)}".encode()).hexdigest()[:16], 16) / 2**64
        total = 0.0
        for c in models.CHARACTERS:
            total += share(h, c)
            if u <= total:
                break
        if c == "$":
            break
        out, h = out + c, (h + c)[-3:]
    return out


@pytest.mark.parametrize("longest", [0, 1, 6])
def test_samples_are_those_of_plain_draws(spark, longest):
    model = models.char_table(spark.createDataFrame([(w,) for w in TRAIN], "word string"))
    tags = spark.createDataFrame([(f"t{i}",) for i in range(40)] + [("t1",)], "tag string")
    unit = lambda tag, i: fn.unit_hash(F.concat(F.lit("s:"), tag, F.lit(":"), i.cast("string")))
    got = [(r["tag"], r["word"]) for r in models.sample_words(tags, model, WEIGHTS, unit, longest).collect()]
    assert sorted(got) == sorted((f"t{i}", drawn(f"t{i}", longest)) for i in [*range(40), 1])
    assert models.sample_words(tags.limit(0), model, WEIGHTS, unit, longest).count() == 0


def test_cumulative_shares_end_at_one(spark):
    model = models.char_table(spark.createDataFrame([(w,) for w in TRAIN], "word string"))
    table = models.next_characters(model, WEIGHTS)
    row = table.agg(F.count("*").alias("n"), F.max(F.abs(F.col("cumulative")[26] - 1)).alias("gap"), F.min(F.size("cumulative")).alias("size")).first()
    assert (row["n"], row["size"]) == (1 + 26 + 26**2 + 26**3, 27) and row["gap"] < 1e-9
