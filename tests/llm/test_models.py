"""Learned operators: held-out accuracy, exact base scores, and defined results for odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordlake.llm import lm, quality, toxicity
from wordlake.llm.common import byte_words

ODD = [None, "", "  ", "!", "x" * 5000]


def corpus(seed=1, n=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(vocabulary[: r.choice([20, 300])]) for _ in range(r.randint(20, 80))]
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(["nasty", "nastyy", "naasty", "nastie"])
        text = " | ".join(words) if bad else " ".join(words)
        rows.append((i, text, 5, "src", "z"))
        labels.append((i, 0 if bad else 1, int(toxic)))
    return rows + [(n + j, t, 5, "src", "z") for j, t in enumerate(ODD)] + [(None, "null id", 5, "src", "z")], labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    return spark.createDataFrame(rows, "doc_id long, text string, label int, source string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("scores,column", [(toxicity.toxicity_scores, "toxic"), (quality.quality_scores, "quality")])
def test_classifiers(tables, scores, column):
    docs, labels = tables
    got = {r["doc_id"]: r for r in scores(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got.values())
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.9
    assert scores(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in scores(docs, labels.limit(0)).collect()} == {0}


def test_quality_against_plain_python(spark, monkeypatch):
    r = random.Random(3)
    texts = [None, "", "one", "one two"] + [" ".join(r.choice("alpha Beta gamma, delta! é中 x1".split()) for _ in range(r.randint(1, 40))) for _ in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(5)
    monkeypatch.setattr(quality, "FAN_IN", 2)
    got = quality.word_vectors(docs)
    sums = {}
    for t in texts * 2:
        words = [quality._number(w) for w in quality._TOKEN.findall(t or "")]
        for i, w in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    for n, place in enumerate(quality.marks()[words[j]].tolist()):
                        sums.setdefault(w, [0] * quality.DIM)[place] += 1 if n < 3 else -1
    for w, total in sums.items():
        own = np.zeros(quality.DIM)
        own[quality.marks()[w]] = [1, 1, 1, -1, -1, -1]
        assert np.allclose(got[w], np.array(total) / max(1e-9, np.sqrt(sum(x * x for x in total))) + own / np.sqrt(6), atol=1e-5)
    assert len(sums) == len({w for t in texts if t for w in quality._TOKEN.findall(t)})  # each word of these has a vector of its own
    words = [quality._number(w) for w in quality._TOKEN.findall(texts[-1])]
    mean = [sum(float(got[w][d]) for w in words) / len(words) for d in range(quality.DIM)]
    assert np.allclose(quality.pooled(np.array(words), got)[: quality.DIM], mean, atol=1e-5)


def test_toxicity_against_plain_python(tables):
    docs, labels = tables
    sample, priors = toxicity.labelled(docs.select("doc_id", "text"), labels, "toxic")
    table = sample.mapInArrow(toxicity._features, "label int, ids binary, weights binary").toArrow()
    vectors, out, bias = toxicity.train(table, priors)

    def plain(text):
        words = toxicity._WORD.findall(text.lower())
        mean = sum(vectors[toxicity.subwords(w)].astype(float).mean(0) for w in words) / len(words) * toxicity.SCALE
        z = mean @ out + bias
        return 1 / (1 + np.exp(z[0] - z[1]))

    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, labels).collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] and toxicity._WORD.search(r["text"])]
    # training takes the sample in the order in which it comes, so two runs agree nearly, not to the last digit
    assert np.corrcoef([got[i] for i, _ in texts], [plain(t) for _, t in texts])[0, 1] > 0.99


def test_drop_toxic_keeps_columns(tables):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_misspellings_share_subwords():
    assert len(set(toxicity.subwords("disgusting")) & set(toxicity.subwords("disgustting"))) > 10


def test_long_words_are_read_whole(monkeypatch):
    long, plain = "ab" * 100 + "nasty", "ab" * 100 + "plain"
    assert set(toxicity.subwords("nasty")[2:-2]) & (set(toxicity.subwords(long)) - set(toxicity.subwords(plain)))
    each = np.random.default_rng(2).normal(size=toxicity.BUCKETS).astype(np.float32)
    want = each[toxicity.subwords(long)].mean()
    assert want != each[toxicity.subwords(plain)].mean()
    monkeypatch.setattr(toxicity, "SLICE", 7)
    at, share = toxicity._shares(long)
    assert len(set(at)) == len(at) and abs(share @ each[at] - want) < 1e-5 and abs(toxicity._mean(long, each) - want) < 1e-5
    known = toxicity._Kept(toxicity._shares)
    assert (known[long][0] == at).all() and long not in known and known["nasty"] and "nasty" in known


def test_lm_scores(tables):
    docs, _ = tables
    got = {r["doc_id"]: r for r in lm.lm_scores(docs, block_chars=20_000).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    counts = Counter(w for i, t in rows if crc(i) for w in [*byte_words(t), "end"])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for i, t in rows:
        words = [*byte_words(t), "end"]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(i) == 0, len(words), sum(counts[w] > 0 for w in words), n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    assert lm.lm_scores(docs.limit(0)).count() == 0


def plain_log_likelihood(document, p):
    """The same network, one token at a time in double precision."""
    p = {k: a.astype(float) for k, a in p.items()}
    h, last, total, n = np.zeros(lm.STATE), lm.START, 0.0, lm.STATE
    share = lambda x, i: x[i] - np.log(np.exp(x).sum())
    for y in document:
        x = p["e"][last] @ p["wx"] + p["b"]
        z, r = (1 / (1 + np.exp(-(x[a : a + n] + h @ p["u"][:, a : a + n]))) for a in (0, n))
        new = np.tanh(x[2 * n :] + (r * h) @ p["u"][:, 2 * n :])
        h = (1 - z) * new + z * h
        c = lm.CLASSES if y == lm.RARE else y // lm.PER
        total += share(h @ p["wc"] + p["bc"], c)
        if c < lm.CLASSES:
            total += share(h @ p["ww"][c] + p["bw"][c], y % lm.PER)
        last = y
    return total


def test_lm_is_a_distribution_and_carries_state():
    r = np.random.default_rng(0)
    p = lm._new(r)
    h = r.normal(size=(lm.STATE, 1)).astype(np.float32)
    every = np.arange(lm.RARE + 1)
    assert abs(np.exp(lm._outputs(np.repeat(h, len(every), 1), every, p)).sum() - 1) < 1e-3
    documents = [r.integers(1, lm.RARE + 1, n) for n in (3, 400, 0, 17, 16)]
    documents = [np.append(d, 0) for d in documents]
    got = lm.log_likelihoods(documents, p)
    for d, x in zip(documents, got):
        assert abs(plain_log_likelihood(d, p) - x) < 1e-4 * abs(x)


def test_lm_gradients_are_those_of_the_log_likelihood():
    r = np.random.default_rng(4)
    p = {k: a + r.normal(0, 0.2, a.shape).astype(np.float32) for k, a in lm._new(r).items()}
    y = r.choice([0, 1, 5, 700, 2000, lm.RARE], (3, 9))
    y[:, -1] = 0
    x = np.where(np.roll(y, 1, 1) == 0, lm.START, np.roll(y, 1, 1))
    g, _ = lm._gradients(x, y, np.ones(y.shape, bool), np.zeros((lm.STATE, 3), np.float32), p)
    cut = lambda row: np.split(row, np.flatnonzero(row == 0)[:-1] + 1)
    loss = lambda q: -sum(plain_log_likelihood(d, q) for row in y for d in cut(row))
    for name, a in p.items():
        for at in sorted(zip(*np.unravel_index(np.argsort(-np.abs(g[name]).ravel())[:4], a.shape))):
            more, less = ({k: b.astype(float) for k, b in p.items()} for _ in range(2))
            more[name][at] += 1e-4
            less[name][at] -= 1e-4
            assert abs((loss(more) - loss(less)) / 2e-4 - g[name][at]) < 1e-2 * max(0.1, abs(g[name][at])), name


def test_lm_learns_from_every_training_document(spark):
    r = random.Random(6)
    n = 3000
    first = {x["doc_id"] for x in spark.range(n).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id")).limit(n * 2 // 3).collect()}
    # the documents with the last hashes go by a rule of their own
    line = lambda i: " ".join(r.choice("pqrs") for _ in range(24)) if i in first else "k l m n o t u v " * 3
    docs = spark.createDataFrame([(i, line(i)) for i in range(n)], "doc_id long, text string").repartition(3).checkpoint()
    gain = [(x["score"] - x["base_score"]) / x["n_tokens"] for x in lm.lm_scores(docs).collect() if x["held_out"] and x["doc_id"] not in first]
    assert len(gain) > 50 and np.mean(gain) > 0.3
