"""The pipeline's stages, each on its own input, and the whole of it."""

import corpus_pipeline
from tests.llm.test_models import corpus
from wordlake.llm.exact_dedup import drop_copies
from wordlake.llm.near_dedup import drop_near_copies
from wordlake.llm.secrets import mask_secrets
from wordlake.llm.toxicity import drop_toxic


def test_stages(spark, tmp_path):
    rows, labels = corpus(seed=2, n=300)
    rows = [(i, t, "en", s, len(t or "")) for i, t, _, s, _ in rows if i is not None]
    base = rows[1][1].split()
    rows += [(1000, rows[1][1] + " ", "en", "s", 1), (1001, " ".join([*base, "one"]), "en", "s", 1), (1002, " ".join(rows[2][1].split()[::-1]) + " token = abcdef123", "en", "s", 17)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert 1 in kept["toxicity"] and 0 not in kept["toxicity"]
    assert 1000 in kept["exact_dedup"] and 1 not in kept["exact_dedup"]  # more code points
    assert 1000 in kept["near_dedup"] and 1001 not in kept["near_dedup"]
    assert kept["secret_scan"][1002].endswith(" [SECRET]") and kept["secret_scan"].keys() == kept["near_dedup"].keys()
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == set(kept["secret_scan"])


def test_stages_tell_rows_apart_by_more_than_their_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    table = lambda *rows: spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in rows], "doc_id long, text string, source string, n_chars long")
    of = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    # two identical rows of one id, copies with a null id, and different texts of one id
    got = of(drop_copies(table((1, "a b"), (1, "a b"), (None, "a b"), (None, "c"), (None, "c"), (2, "d"), (2, "a b"))))
    assert got == sorted([(1, "a b"), (None, "c"), (2, "d")], key=repr)
    got = of(drop_near_copies(table((7, words), (7, words + " x"), (None, words + " y"), (7, "else"), (5, words), (None, "z z"), (None, None))))
    assert got == sorted([(5, words), (7, "else"), (None, "z z"), (None, None)], key=repr)
    got = of(mask_secrets(table((None, "token = abcdef123"), (3, "token = abcdef123 and"), (3, "see the token = abcdef123"), (3, "no"))))
    assert got == sorted([(None, "[SECRET]"), (3, "[SECRET] and"), (3, "see the [SECRET]"), (3, "no")], key=repr)
    rows, labels = corpus(seed=3, n=300)
    bad = " ".join(["nasty naasty nastie"] * 8)
    odd = [(None, bad), (900, bad), (900, rows[1][1])]
    kept = of(drop_toxic(table(*[(i, t) for i, t, *_ in rows if i is not None], *odd), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert (900, rows[1][1]) in kept and not {(None, bad), (900, bad)} & set(kept)


def test_run_on_odd_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    _, labels = corpus(n=50)
    long = " ".join(f"w{i}" for i in range(40_000)) + " password = abcdef123"
    rows = [(None, None), (1, None), (1, ""), (2, long), (2, long), (None, long + " "), (3, "a"), (3, "a b")]
    for name, own in (("odd", rows), ("empty", [])):
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in own], schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert len({(r["doc_id"], r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
        # the row of most code points stays of the long ones, and one of those without text
        wholes = [r["doc_id"] for r in packed if r["piece"] == 0]
        assert sorted(wholes, key=repr) == ([1, 3, 3, None] if own else []), wholes
