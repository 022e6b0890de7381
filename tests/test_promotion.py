"""Promotion with defaults, draws that refuse, answers' paths, and ranks over ranges, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from wordlake.operators import lists, records, stats

META = "word string, source string, added_date string, validation_status string"


def test_promotion_is_idempotent_and_has_defaults(spark):
    old = spark.createDataFrame([("cat", "twl", "2025-01-01", "valid")], META)
    batch = spark.createDataFrame([(" Cat ", "new", None, None), ("DOG", None, None, None), ("emu", "ledger", None, "valid"), ("emu", None, None, None), ("", None, None, None)], META)
    once = lists.promoted_dictionary(old, batch, "2026-01-01")
    want = [("cat", "twl", "2025-01-01", "valid"), ("dog", "phase3_update", "2026-01-01", "valid"), ("emu", "ledger", None, "valid")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, lists.promoted_dictionary(once, batch, "2027-01-01").collect())) == want


def test_sources_that_never_answered(spark):
    rows = spark.createDataFrame([("valid", None, "not_consulted"), ("error", "not_consulted", None)], "a string, b string, c string")
    assert sorted(map(tuple, lists.never_consulted(rows, ["a", "b", "c"]).collect())) == [("b", 0, 2), ("c", 0, 2)]
    assert lists.never_consulted(rows.limit(0), ["a", "b"]).count() == 0


def test_draws_refuse_short_and_missing_strata(spark):
    frame = spark.createDataFrame([(f"w{i}", "1" if i < 30 else "0") for i in range(50)], "word string, stratum string")
    got = stats.draw(frame, "7", "stratum", "word", {"1": 10, "0": 3}).groupBy("stratum").count().collect()
    assert {r["stratum"]: r["count"] for r in got} == {"1": 10, "0": 3}
    first = {r["word"] for r in stats.draw(frame, "7", "stratum", "word", {"1": 10}).collect()}
    assert first == {r["word"] for r in stats.draw(frame.repartition(5), "7", "stratum", "word", {"1": 10}).collect()} != {r["word"] for r in stats.draw(frame, "8", "stratum", "word", {"1": 10}).collect()}
    for sizes in ({"0": 21}, {"9": 1}):
        with pytest.raises(ValueError, match="cannot draw"):
            stats.draw(frame, "7", "stratum", "word", sizes)


def test_paths_of_answers(spark):
    good = '{"def":[{"sseq":[[["sense",{"dt":[["vis",[{"t":"x"}]],["text"," {bc}a {sx|cat||} kind "],["text","b"]]}]]]}],"et":[["text","from Latin"]],"hwi":{"prs":[{"mw":"kat"},{"mw":"x"}]},"manual_validation":{"by":"x"}}'
    odd = ['{"def":[{"sseq":[]}],"et":"x","hwi":[]}', '{"def":{},"et":[],"hwi":{"prs":[]}}', "[]", "no json", None]
    e = F.col("e")
    made = spark.createDataFrame([(x,) for x in [good, *odd]], "e string").select(records.definition_of(e).alias("d"), records.etymology_of(e).alias("t"), records.pronunciation_of(e).alias("p"), *records.relabelled(e, F.lit("invalid")))
    rows = [tuple(r) for r in made.collect()]
    assert rows[0] == ("a cat kind", "from Latin", "kat", "invalid", None)
    assert all(r == (None, None, None, None, "invalid") for r in rows[1:])


def plain_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    if min(len(pos), len(neg)) < 10:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_auc_over_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(stats, "RANGES", ranges)
    r = random.Random(ranges)
    rows = [("g", r.random(), r.random() < 0.4) for _ in range(400)] + [("h", float(r.randint(0, 3)), r.random() < 0.5) for _ in range(200)] + [(None, 1.0, i < 12) for i in range(30)] + [("few", 1.0, True)]
    got = {x["g"]: x["auc"] for x in stats.auc(spark.createDataFrame(rows, "g string, score double, label boolean"), ["g"]).collect()}
    for g in ("g", "h", None, "few"):
        want = plain_auc([(s, y) for k, s, y in rows if k == g])
        assert got[g] is want or abs(got[g] - want) < 1e-12
