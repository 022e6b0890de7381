"""Language identification: n-grams, document frequencies and learning against plain versions, and odd rows."""

import math
import random
import unicodedata
import zlib

import numpy as np
import pytest

from wordlake.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, score int, held_out string"
WORDS = {"ka": "kala maki tora kuna", "mo": "momo lumi moru nomi", "zh": "中文 字典 語言 學習"}


def plain_grams(text):
    p = " " + "".join(ch if unicodedata.category(ch).startswith("L") else " " for ch in text.lower()) + " "
    out = []
    for n in range(1, 5):
        for i in range(len(p) - n + 1):
            g = p[i : i + n]
            if g.strip() and " " not in g[1:-1] and (n > 1 or g != " ") and not (n == 2 and g == "  "):
                h = 1
                for ch in g:
                    h = (h * 0x01000193 + (0 if ch == " " else ord(ch))) % 2**32
                h ^= h >> 15
                out.append((h * 0x9E3779B1 % 2**32) >> (32 - language.BITS))
    return sorted(out)


@pytest.mark.parametrize("cut", [1, 2, 5, 1 << 20])
def test_grams(monkeypatch, cut):
    monkeypatch.setattr(language, "SLICE", cut)
    for text in ["", "a", "1 2", "Ab c", "d'été 12 x—y", "中文字", "İi", "áb", "word " * 7, " \n lead"]:
        assert sorted(np.concatenate([np.zeros(0, np.int64), *language.grams(text)]).tolist()) == plain_grams(text)


def documents(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        rows.append((i, " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randint(1, 30))), lang, "s", 1, "x"))
    return rows


def learned_from(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 4 != 2


def test_held_out_rows_and_odd_rows(spark):
    rows = documents(300)
    odd = [(1000, None, "ka", "", 1, ""), (1001, "", "ka", "", 1, ""), (1002, "12 !?", "mo", "", 1, ""), (1003, "kala " * 100_000, None, "", 1, ""), (None, "momo lumi", "mo", "", 1, ""), (7, rows[7][1], rows[7][2], "", 1, ""), (1004, "ωψ", None, "", 1, "")]
    table = spark.createDataFrame(rows + odd, SCHEMA)
    got = language.languages(table.repartition(3)).collect()
    assert len(got) == len(rows) + len(odd) and set(got[0].asDict()) == {"doc_id", "held_out", "lang_pred", "score"}
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == lang and 0.5 < by[i]["score"] <= 1 for i, _, lang, *_ in rows)
    assert all(by[i]["held_out"] == (not learned_from(i)) for i in by)
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003]["lang_pred"] == "ka" and by[None]["lang_pred"] == "mo" and by[1004]["lang_pred"] in WORDS
    again = language.languages(table.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)  # the same whatever the partitions


def test_nothing_to_learn_from(spark):
    assert language.languages(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = language.languages(spark.createDataFrame([(1, "abc", None, "", 1, ""), (2, "abc", None, "", 1, "")], SCHEMA)).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}
    one = next(i for i in range(100) if learned_from(i))
    assert [r["lang_pred"] for r in language.languages(spark.createDataFrame([(one, "abc", "xx", "", 1, ""), (one, "q", "xx", "", 1, "")], SCHEMA)).collect()] == ["xx", "xx"]


def test_sample_is_bounded_and_even(spark):
    rows = [(i, f"text {i}", "ka", "", 1, "") for i in range(2000)] + [(5, "text 5", "ka", "", 1, "")] * 3000 + [(i, f"text {i}", "mo", "", 1, "") for i in range(30)]
    known = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "xxhash64(doc_id, text) as __hash")
    got = [r["lang"] + r["text"] for r in language.sampled(known, {"ka": 2 * 100 / 2000, "mo": 2 * 100 / 30}, 100).collect()]
    assert len(set(got)) == len(got) == 130
    least = known.where("lang = 'ka'").select("__hash", "text").distinct().orderBy("__hash").limit(100).collect()
    assert {"ka" + r["text"] for r in least} == {x for x in got if x.startswith("ka")}


def test_document_frequencies(spark, monkeypatch):
    monkeypatch.setattr(language, "FAN_IN", 2)
    texts = [t for _, t, *_ in documents(60)] + ["", "7"]
    found = language.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    want = np.zeros(language.BUCKETS, int)
    for t in texts:
        want[sorted(set(plain_grams(t)))] += 1
    assert (found[:-1] == want).all() and found[-1] == len(texts)


def test_leader_against_plain_rounds():
    r = np.random.default_rng(3)
    model, langs, size = language.Leader(6, 3), 3, 6
    z, n = [[0.0] * langs for _ in range(size + 1)], [[0.0] * langs for _ in range(size + 1)]

    def weight(i, k):
        if i < size and abs(z[i][k]) <= language.L1:
            return 0.0
        keep = z[i][k] - (math.copysign(language.L1, z[i][k]) if i < size else 0)
        return -keep / ((language.BETA + math.sqrt(n[i][k])) / language.ALPHA + (language.L2 if i < size else 0))

    for step in range(50):
        at, y = np.sort(r.choice(size, 3, replace=False)), int(r.integers(langs))
        x = r.random(3) * (0.1 if step < 25 else 4)
        model.learn(at, x, y, 1.5)
        if step == 24:
            assert (model.weights(slice(0, -1)) == 0).any()  # few and weak slopes leave a weight at 0
        each = [*zip(at.tolist(), x.tolist()), (size, 1.0)]
        w = {(i, k): weight(i, k) for i, _ in each for k in range(langs)}
        s = [sum(v * w[i, k] for i, v in each) for k in range(langs)]
        p = [math.exp(a - max(s)) for a in s]
        for i, v in each:
            for k in range(langs):
                g = 1.5 * v * (p[k] / sum(p) - (k == y))
                z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / language.ALPHA * w[i, k]
                n[i][k] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
    assert np.allclose(model.weights(slice(0, -1)), [[weight(i, k) for k in range(langs)] for i in range(size)])


def test_temperature_lowers_the_loss_of_noisy_labels():
    r = np.random.default_rng(5)
    docs = []
    for i in range(600):
        y = int(r.integers(2))
        docs.append((y if r.random() < 0.8 else 1 - y, np.array([y]), np.array([1.0])))
    weights, bias, heat = language.train(docs, np.ones(4), np.array([0.5, 0.5]))
    p = language.softmax((weights[0] + bias) / heat)
    assert 0.7 < p[0] < 0.9  # the share of the first n-gram's documents that bear the first label
