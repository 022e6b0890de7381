"""Verified output, kept tables and bounded allocation."""

import json
import random

import pytest
from pyspark.sql import functions as F

from wordlake.operators import stats
from wordlake.sources import sinks, store
from wordlake.sources.files import dictionary


def words(spark, n, letters="abc"):
    return spark.createDataFrame([(f"{letters[i % len(letters)]}{i:04d}", i) for i in range(n)], "word string, n int").withColumn("letter", F.left("word", F.lit(1)))


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_parts_are_written_verified_and_replaced(spark, tmp_path, kind):
    path, schema = str(tmp_path / "out"), "word string, n int, letter string"
    manifest = sinks.write_parts(words(spark, 90), path, "letter", ["word"], kind=kind)
    assert sorted((r["part"], r["rows"]) for r in manifest.collect()) == [("a", 30), ("b", 30), ("c", 30)]
    back = lambda: sorted(map(tuple, sinks.read_parts(spark, path, schema, kind).select("word", "n", "letter").collect()))
    assert back() == sorted(map(tuple, words(spark, 90).collect()))
    # fewer parts: the old ones are gone; the digest follows the rows, not their order
    sinks.write_parts(words(spark, 60, "ab"), path, "letter", ["word"], kind=kind)
    assert {r[2] for r in back()} == {"a", "b"} and len(folders(tmp_path / "out")) == 1
    same = sinks.part_sums(words(spark, 60, "ab").repartition(7), "letter")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, sinks.published_manifest(spark, path).collect()))
    for few in (0, 20):
        with pytest.raises(sinks.UnverifiedError):
            sinks.write_parts(words(spark, few), path, "letter", ["word"], kind=kind)
    assert len(back()) == 60 and len(folders(tmp_path / "out")) == 1  # what was published stays, the draft is gone


def test_output_that_differs_is_refused(spark, tmp_path, monkeypatch):
    real = sinks.part_sums
    calls = []

    def off(table, part):
        calls.append(1)
        found = real(table, part)
        return found.withColumn("rows", F.col("rows") + 1) if len(calls) == 2 else found

    monkeypatch.setattr(sinks, "part_sums", off)
    with pytest.raises(sinks.UnverifiedError):
        sinks.write_parts(words(spark, 30), str(tmp_path / "x"), "letter", ["word"])
    assert store.pointed(spark, str(tmp_path / "x")) is None


def test_key_set(spark, tmp_path):
    w = spark.createDataFrame([("b",), ("a",), ("b",), ("x" * 101,)], "word string")
    row = sinks.key_set(w, str(tmp_path / "k")).first()
    assert (row["keys"], row["over_length"]) == (3, 1)
    assert row["digest"] == sinks.key_set(w.repartition(5), str(tmp_path / "l")).first()["digest"]


def test_objects_round_trip(spark, tmp_path):
    rows = [('qu"o,te', 1, None), ("é {", 2, "x, y"), ("", 3, "}"), ("back\\slash", 4, '"')]
    sinks.write_objects(spark.createDataFrame(rows, "word string, n int, t string").repartition(2), str(tmp_path / "o"), "word")
    for part in (tmp_path / "o").glob("part-*"):
        text = part.read_text()
        assert not text.strip() or isinstance(json.loads(text), dict)
    got = dictionary(spark, str(tmp_path / "o"), ("n", "t")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(w, str(n), t) for w, n, t in rows], key=repr)
    sinks.write_objects(spark.createDataFrame(rows, "word string, n int, t string").limit(0), str(tmp_path / "none"), "word")
    assert dictionary(spark, str(tmp_path / "none")).count() == 0


def test_kept_table_follows_its_derivation_and_ignores_leftovers(spark, tmp_path):
    src = str(tmp_path / "src")
    words(spark, 10).write.parquet(src)
    read = lambda: spark.read.parquet(src)
    first = store.stored(read(), "t", lambda: read().select("word", "n"), "word")
    assert store.stored(read(), "t", lambda: read().select("word", "n"), "word").inputFiles() == first.inputFiles()
    other = store.stored(read(), "t", lambda: read().select("word", (F.col("n") + 1).alias("n")), "word")
    assert other.agg(F.sum("n")).first()[0] == first.agg(F.sum("n")).first()[0] + 10
    # a writer that broke off: a folder without a pointer
    derived = read().select("word", F.lit(1).alias("one"))
    place = f"{store.folder(spark)}/t-{store.fingerprint(read())}-{store.derivation(derived)}"
    left, files = store.hadoop_path(spark, f"{place}/v-left")
    files.mkdirs(left)
    assert store.stored(read(), "t", lambda: derived, "word").count() == 10


def dealt(sizes, caps, target):
    """The plain rounds."""
    total = sum(sizes.values())
    exact = {b: n * target / total for b, n in sizes.items()}
    got = {b: min(caps[b], int(exact[b])) for b in sizes}
    left = target - sum(got.values())
    for b in sorted(sizes, key=lambda b: (-(exact[b] - got[b]), b)):
        if left > 0 and got[b] < caps[b]:
            got[b], left = got[b] + 1, left - 1
    while left > 0 and any(got[b] < caps[b] for b in sizes):
        for b in sorted(sizes):
            if left > 0 and got[b] < caps[b]:
                got[b], left = got[b] + 1, left - 1
    return got


def test_allocation(spark):
    r = random.Random(4)
    for case in range(8):
        sizes = {chr(97 + i): r.randint(1, 60) for i in range(r.randint(1, 12))}
        caps = {b: r.randint(0, n) if case % 2 else n for b, n in sizes.items()}
        target = r.randint(0, sum(sizes.values()) + (20 if case > 5 else 0))
        table = spark.createDataFrame([(b, n, caps[b]) for b, n in sizes.items()], "bucket string, n long, cap long")
        got = {x["bucket"]: x["goal"] for x in stats.allocation(table, target, "cap").collect()}
        assert got == dealt(sizes, caps, target), (sizes, caps, target)


def test_best_of_buckets(spark):
    scored = spark.createDataFrame([("a", 1.0, "x", "k1"), ("a", 2.0, "y", "k2"), ("a", 2.0, "x", "k3"), ("b", 1.0, "x", "k4")], "bucket string, score double, tie string, word string")
    goals = spark.createDataFrame([("a", 2), ("b", 0)], "bucket string, goal long")
    got = stats.best_of_buckets(scored, goals, "bucket", "score", "tie", "word").collect()
    assert sorted((r["word"], r["rank"]) for r in got) == [("k2", 2), ("k3", 1)]
