"""Every registered word-list query against its SQL in DuckDB, and the functions' edge cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from wordlake.functions import words as fn
from wordlake.operators import lists
from wordlake.operators.search import Query, search
from wordlake.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_functions(spark):
    assert one(spark, fn.fnv1a(F.lit("cat"))) == 108289031
    assert abs(one(spark, fn.unit_hash(F.lit("phase2-partitions-2026-08-17:blameworthy"))) - 0.9867047222897237) < 1e-12
    assert [one(spark, fn.normalise(F.lit(x))) for x in ("Straße", "K", "a-b", "abc\n", "")] == ["strasse", "k", None, None, None]
    assert [one(spark, fn.form_reason(F.lit(x))) for x in ("", "Ab", "a-b", "a", "b" * 46, "word")] == ["empty", "uppercase", "non-alphabetic", "too short", "too long", None]
    assert one(spark, fn.glob(F.lit("norteño"), "norte_o")) is False and one(spark, fn.glob(F.lit("norteño"), "norte__o")) is True
    assert set(one(spark, fn.edits(F.lit("ab")))) >= {"a", "b", "ba", "abc", "aab", "xb"} and "ab" not in one(spark, fn.edits(F.lit("ab")))


def test_query_as_url_and_errors(spark):
    q = Query("th e", "pattern", least=3, intakes=("twl", "other"), sort="added", descending=True)
    assert Query.from_url(q.to_url()) == q and Query().to_url() == "" and "%20" in q.to_url()
    assert Query.from_url("?m=odd&min=x&s=nothing&i=none&l=ab&ch=odd&c=1&d=0") == Query()
    assert Query.from_url("?q=th&m=suffix&min=3&max=9&i=twl,other&l=a,q&ch=alpha&c=0&s=length&d=1") == Query("th", "suffix", 3, 9, ("twl", "other"), ("a", "q"), "alpha", True, "length", True)
    assert Query("th", least=3, hide_contested=True, descending=True).to_url() == "q=th&min=3&d=1&c=0"
    with pytest.raises(ValueError):
        search(spark.createDataFrame([("a",)], "word string"), Query("(", "regex"))


def test_lists(spark, tmp_path):
    w = lambda *x: spark.createDataFrame([(i,) for i in x], "word string")
    words = lambda df: sorted(r["word"] for r in df.collect())
    valid, invalid = lists.promote(w("a"), w("b", "c"), w("b", "b", "a"))
    assert (words(valid), words(invalid)) == (["a", "b"], ["c"])
    ledger = spark.createDataFrame([("a", "yes", "remove_from_invalid_list")], "word string, reversible string, action string")
    assert [words(x) for x in lists.demote(w("a", "b"), w("c"), ledger)] == [["b"], ["a", "c"]]
    assert words(lists.apply_ledger(w("a"), w("a", "d"), ledger)) == ["d"]
    with pytest.raises(lists.RefusedError):
        lists.demote(w("b"), w("c"), ledger)
    problems = {r["word"]: r["problem"] for r in lists.reconcile(w("a", "b", "c"), w("a", "c", "d", "e"), w("c"), w("e", "f")).collect()}
    assert problems == {"b": "lost", "c": "not removed", "d": "unexplained", "f": "not added"}
    assert lists.guarded_overwrite(w("b", "a"), str(tmp_path / "list"), 3) == 2
    with pytest.raises(lists.RefusedError):
        lists.guarded_overwrite(w("a"), str(tmp_path / "list"), 3)


def test_verdict_stream(spark, tmp_path):
    from wordlake.streaming import refused, replay, verdict_stream

    lines = [("2026-01-01", "x", "verdict", "word"), ("2026-01-02", "x", "verdict_amend", "not"), ("2026-01-03", "x", "search", None)]
    (tmp_path / "a.json").write_text("".join(f'{{"ts":"{t}T00:00:00Z","item_id":"{i}","event":"{e}"' + (f',"verdict":"{v}"' if v else "") + "}\n" for t, i, e, v in lines))
    q = verdict_stream(spark, str(tmp_path)).writeStream.format("memory").queryName("verdicts").outputMode("complete").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert [(r["item_id"], r["verdict"], r["events"]) for r in spark.table("verdicts").collect()] == [("x", "not", 3)]
    log = spark.createDataFrame([(1, "a", "search", "s1", None), (2, "a", "verdict", None, "word"), (3, "a", "search", "s2", None), (4, "a", "verdict_amend", None, "not"), (5, "a", "verdict", None, "word"), (6, "b", "verdict_amend", None, "x"), (7, "c", "search", "s3", None)], "seq long, item_id string, event string, instrument string, verdict string")
    got = {r["item_id"]: (r["verdict"], r["amended"], r["searches"]) for r in replay(log).collect()}
    assert got == {"a": ("word", 1, ["s1", "s2"]), "b": ("x", 1, []), "c": (None, 0, ["s3"])}
    assert {(r["item_id"], r["seq"]) for r in refused(log).collect()} == {("a", 5), ("b", 6)}


def test_word_tables_are_pruned_and_kept(spark):
    from wordlake.sources.lexicon import words

    w = words(spark, DATA)
    plan = search(w, Query("th", least=3, intakes=("twl",)))._jdf.queryExecution().toString()
    assert "StringStartsWith(word,th)" in plan and "In(intake" in plan or "EqualTo(intake,twl)" in plan
    assert words(spark, DATA).inputFiles() == w.inputFiles() and "Exchange" not in plan
    first = [r["word"] for r in w.collect()]
    assert len(set(first)) == len(first)


def test_forms(spark):
    from wordlake.functions import forms

    at = lambda f, word: one(spark, f(F.lit(word)))
    stems = lambda word: at(forms.comparative_stems, word)
    assert "red" in stems("redder") and "happy" in stems("happiest") and "abatable" in stems("abatabler") and "large" in stems("larger")
    assert ("ing", "bake") in [(p["affix"], p["stem"]) for p in at(forms.suffix_parses, "baking")] and ("ing", "run") in [(p["affix"], p["stem"]) for p in at(forms.suffix_parses, "running")]
    assert ("ness", "happy") in [(p["affix"], p["stem"]) for p in at(forms.suffix_parses, "happiness")]
    assert "schoolmaster" in at(forms.scan_sources, "schoolinaster") and at(forms.scan_sources, "dog") == []
    assert [at(forms.likely_english, w) for w in ("abdominocutaneousest", "laryngoscopicalest", "abatabler", "aaab", "qat")] == [False, False, True, False, False]
    assert at(lambda w: forms.misread(w, F.lit(0.0)), "mm") == "inm" and at(lambda w: forms.misread(w, F.lit(0.99)), "zzz") is None


def test_form_ledger_and_guard(spark, tmp_path):
    w = lambda *x: spark.createDataFrame([(i,) for i in x], "word string")
    words = lambda df: sorted(r["word"] for r in df.collect())
    ledger = lists.form_ledger(w("ad-lib", "-ness", "norteño", "fine", "x1"), w("ness", "fine"))
    got = {(r["word"], r["action"], r["category"], r["listed"]) for r in ledger.collect()}
    assert got == {("ad-lib", "delete_malformed", "compound", False), ("-ness", "delete_malformed", "fragment", True), ("norteño", "delete_malformed", "accented", False), ("x1", "delete_malformed", "compound", False), ("adlib", "add_candidate", "plain-form", False), ("norteno", "add_candidate", "plain-form", False), ("x", "add_candidate", "plain-form", False)}
    frame = w("ness", "fine", "ad-lib", "-ness", "norteño", "x1")
    assert words(lists.apply_form_ledger(frame, ledger)) == ["adlib", "fine", "ness", "norteno", "x"]
    with pytest.raises(lists.RefusedError):
        lists.apply_form_ledger(w("fine"), spark.createDataFrame([("fine", "delete_malformed")], "word string, action string"))
    place = str(tmp_path / "list")
    lists.guarded_overwrite(w("b", "a", "c"), place, 3)
    assert lists.guarded_overwrite(spark.read.text(place).withColumnRenamed("value", "word").where("word <> 'c'"), place, 3) == 2  # from the list itself
    assert sorted(r["value"] for r in spark.read.text(place).collect()) == ["a", "b"]
    checked = spark.createDataFrame([("never", None), ("ancient", "2025-01-01"), ("recent", "2026-02-14")], "word string, checked string").withColumn("checked", F.col("checked").cast("date"))
    assert [r["word"] for r in lists.due(checked, "2026-02-15").collect()] == ["never", "ancient"] and words(lists.evict(checked, "2026-02-15")) == ["recent"]


def test_lexicon_counts_an_id_once_wherever_it_stands(spark, tmp_path):
    from wordlake.sources.lexicon import WORDS_SQL, word_sources, words

    docs = [(1, "Ärger the the cat", "src1"), (1, "the dog café", "src1"), (1, "the emu", "src2"), (2, "cat's CAT\ncat", "src3"), (3, None, "src3"), (4, "", "src4"), (None, "the gnu", "src5"), (None, "the gnu", "src5"), (5, "the ox", None)]
    for name, held in (("some ids twice", docs), ("each id once", [d for d in docs if d[0] != 1]), ("nothing", [])):
        folder = tmp_path / name.replace(" ", "-")
        spark.createDataFrame(held, "doc_id long, text string, source string").write.parquet(str(folder / "documents.parquet"))
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
        for made, sql in ((words(spark, str(folder)), "select * from words"), (word_sources(spark, str(folder)), "select w, source, count(*) as n, count(distinct doc_id) as d, min(doc_id) as first_doc from tokens group by all")):
            want = con.execute(f"with {WORDS_SQL} {sql}").fetchall()
            columns = [d[0] for d in con.description]
            assert rows(columns, want) == rows(columns, [[r[c] for c in columns] for r in made.collect()]), name


def test_lexicon_shuffles_no_row_per_word_and_document(spark):
    from wordlake.sources import lexicon

    docs = spark.createDataFrame([(i, "the cat and the dog", "src1") for i in range(1000)], "doc_id long, text string, source string")
    made = lexicon._by_source(lexicon._tallies(docs))
    rows_out = made._jdf.queryExecution().executedPlan().toString().split("\n")
    keys = [line for line in rows_out if "Exchange hashpartitioning" in line]
    assert len(keys) == 1 and "doc_id" not in keys[0]


def by_word(df):
    """The joins and exchanges of a plan that go by words."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if ("Join" in line or "Exchange" in line) and ("[word#" in line or "(word#" in line)]


def test_records_are_made_of_a_words_own_row(spark):
    from wordlake.plans.records import records
    from wordlake.sources.lexicon import words

    every, twice = records(spark, DATA), records(spark, DATA, least=2)
    assert by_word(every) == [] == by_word(twice)
    often = every.join(words(spark, DATA).where("n_tokens >= 2").select("word"), "word", "left_semi")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, often.collect()))


def test_families_are_told_from_a_words_own_row(spark):
    from wordlake.plans.gates import _families
    from wordlake.sources.lexicon import words

    made = _families(words(spark, DATA))
    assert by_word(made) == []
    assert by_word(QUERIES["l24_firing_rates"](spark, DATA)) == []
    single = {r["word"] for r in made.where("family = 'single'").collect()}
    assert single == {r["word"] for r in words(spark, DATA).where("n_docs = 1").collect()}


def test_agreement_does_not_join_words_with_themselves(spark):
    assert by_word(QUERIES["f27_agreement"](spark, DATA)) == []


def test_word_tables_have_files_for_every_core(spark):
    from wordlake.sources.lexicon import words

    assert len(words(spark, DATA).inputFiles()) > 2 * spark.sparkContext.defaultParallelism


def test_word_tables_have_files_by_the_size_of_their_source(spark, tmp_path, monkeypatch):
    from wordlake.sources import store

    few, many = (spark.range(2000).select((F.col("id") % m).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("word")) for m in (2, 3))
    few.repartition(4).write.parquet(str(tmp_path / "few"))
    many.repartition(4).write.parquet(str(tmp_path / "many"))
    made = lambda name: (lambda df: store.stored(df, name, lambda: df.select("word", "n"), "word"))(spark.read.parquet(str(tmp_path / name)))
    by_core = len(made("few").inputFiles())
    assert by_core <= store.FILES_A_CORE * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(store, "SOURCE_A_FILE", 4 << 10, raising=False)
    by_size = made("many")
    assert len(by_size.inputFiles()) > 2 * by_core
    assert sorted(map(tuple, by_size.collect())) == sorted(map(tuple, many.select("word", "n").collect()))
