"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, a
document the mean of its words, and a linear softmax reads the document; vectors
and softmax are trained jointly in numpy.  A misspelling shares most n-grams
with the word it comes from.  As all of it up to the softmax is linear, a word
has one number to add to the logit, which a task keeps for words seen before.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, columns_of, crc_remainder, numbered, only_ids, rows, save

BUCKETS, DIM = 1 << 17, 8
NGRAMS = (3, 4, 5, 6)
#: Labelled rows of each label that training takes at most, by the order of their ids' hashes.
PER_LABEL = 3000
EPOCHS, BATCH, RATE, SCALE = 15, 64, 0.1, 100.0
THRESHOLD = 0.3
#: Longer words are not kept, and their n-grams are summed SLICE starts at a time.
LONG, SLICE = 64, 1 << 16
_WORD = re.compile(r"\w+")


def _slices(word: str) -> Iterator[np.ndarray]:
    """Buckets of the whole word and of all its n-grams, with marks at both ends, a bounded number at a time."""
    marked = f"<{word}>"
    for a in range(0, len(marked), SLICE):
        grams = [marked] * (a == 0) + [marked[i : i + n] for n in NGRAMS for i in range(a, min(a + SLICE, len(marked) - n + 1))]
        yield np.array([zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams], np.int64)


def subwords(word: str) -> np.ndarray:
    """Buckets of the whole word and of its n-grams, with marks at both ends."""
    return np.concatenate(list(_slices(word)))


def _shares(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a word and the share of the word's mean that each has; of a long word every bucket once."""
    if len(word) <= LONG:
        at = subwords(word)
        return at, np.full(len(at), 1 / len(at))
    counts = sum(np.bincount(x, minlength=BUCKETS) for x in _slices(word))
    at = np.flatnonzero(counts)
    return at, counts[at] / counts.sum()


def _mean(word: str, each: np.ndarray) -> float:
    """The mean of each over the word's buckets."""
    if len(word) <= LONG:
        return float(each[subwords(word)].mean())
    total, n = 0.0, 0
    for x in _slices(word):
        total, n = total + float(each[x].sum(dtype=np.float64)), n + len(x)
    return total / n


class _Kept(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        value = self.make(word)
        if len(word) <= LONG:
            self[word] = value
        return value


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Kept(_shares)
    for batch in batches:
        ids, weights = [], []
        for (text,) in rows(batch, "text"):
            words = _WORD.findall((text or "").lower())
            each = [(known[word], n) for word, n in Counter(words).items()]
            at, where = np.unique(np.concatenate([np.zeros(0, np.int64), *(b for (b, _), _ in each)]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([np.zeros(0), *(share * (n / len(words)) for (_, share), n in each)]), len(at))
            ids.append(at.astype("<u4").tobytes()), weights.append(sums.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(ids, pa.binary()), pa.array(weights, pa.binary())], ["label", "ids", "weights"])


def train(table: pa.Table, priors: dict[int, float], seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, softmax weights and biases; rows count so that labels have the shares that they have among all labelled rows."""
    label = table["label"].to_numpy().astype(np.int64)
    ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in table["ids"].to_pylist()]
    weights = [np.frombuffer(x, np.float32) * SCALE for x in table["weights"].to_pylist()]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    out[:, 1] = rng.normal(0, 0.3, DIM)
    share = np.bincount(label, minlength=2) / max(1, len(label))
    balance = np.array([priors.get(c, 0) / share[c] if share[c] else 0 for c in (0, 1)])
    past = [np.full_like(p, 1e-6) for p in (vectors, out, bias)]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(label))
        for a in range(0, len(order), BATCH):
            own = [i for i in order[a : a + BATCH] if len(ids[i])]
            if not own:
                continue
            at, w = np.concatenate([ids[i] for i in own]), np.concatenate([weights[i] for i in own])
            sizes = np.array([len(ids[i]) for i in own])
            starts = np.cumsum(sizes) - sizes
            h = np.add.reduceat(vectors[at] * w[:, None], starts, axis=0)
            z = h @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), label[own]] -= 1
            p *= (balance[label[own]] / len(own))[:, None]
            back = np.repeat(p @ out.T, sizes, axis=0) * w[:, None]
            used, where = np.unique(at, return_inverse=True)
            step = np.stack([np.bincount(where, back[:, d], len(used)) for d in range(DIM)], 1)
            past[0][used] += step**2
            vectors[used] -= rate * step / np.sqrt(past[0][used])
            for value, gap, k in ((out, h.T @ p, 1), (bias, p.sum(0), 2)):
                past[k] += gap**2
                value -= rate * gap / np.sqrt(past[k])
    return vectors, out, bias


def labelled(docs: DataFrame, labels: DataFrame, column: str, per_label: int = PER_LABEL) -> tuple[DataFrame, dict[int, float]]:
    """The training sample (label, text) and the labels' shares among all rows that may be learned from.

    Rows whose crc32(doc_id as text) mod 4 is 2 are never learned from.  At most
    per_label rows of either label are taken, in the order of their ids' hashes;
    a document with several labels counts by the largest, unlabelled rows not.
    """
    known = labels.select(F.col("doc_id"), F.col(column).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(crc_remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for c in (0, 1)]
    sample = save(parts[0].unionByName(parts[1]))
    total = max(1, sum(counts.values()))
    return only_ids(docs, sample, "doc_id").join(F.broadcast(sample), "doc_id").select("label", "text"), {c: n / total for c, n in counts.items()}


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD, row_col: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    The score comes from the text alone; a null, empty or wordless text scores
    as the labels' share.  Without labelled rows every score is 0.  Repeated
    rows and null ids are scored like any other; other columns are not read, but row_col, if
    given, comes first in the result.
    """
    keys = [row_col] if row_col else []
    source = columns_of(docs, *keys, "doc_id", "text")
    sample, priors = labelled(source, labels, "toxic", per_label)

    def fit(table: pa.Table) -> pa.Table:
        vectors, out, bias = train(table, priors)
        each = vectors @ (out[:, 1] - out[:, 0]) * SCALE
        return pa.table({"words": pa.array([each.astype(np.float32).tobytes()], pa.binary()), "bias": pa.array([float(bias[1] - bias[0])])})

    made = sample.mapInArrow(_features, "label int, ids binary, weights binary")
    model = made.groupBy(F.lit("all")).applyInArrow(fit, "words binary, bias double").collect()  # one row of a fixed size
    each, bias = (np.frombuffer(model[0]["words"], np.float32), model[0]["bias"]) if model else (np.zeros(BUCKETS, np.float32), -1e9)
    share = priors.get(1, 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = _Kept(lambda word: _mean(word, each))
        for batch in batches:
            out = []
            for (text,) in rows(batch, "text"):
                words = _WORD.findall((text or "").lower())
                logit = sum(map(worth.__getitem__, words)) / len(words) + bias if words else None
                out.append(share if logit is None else float(1 / (1 + np.exp(-np.clip(logit, -700, 700)))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "doc_id")), pa.array(out, pa.float64())], [*keys, "doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(score, "".join(f"{c} long, " for c in keys) + f"doc_id {kind}, score double")
    return scored.select(*keys, "doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, all columns.

    Rows are told apart by a number of their own.  A null, empty or wordless
    text goes only where most labelled rows are toxic beyond the threshold.
    """
    table = numbered(docs)
    gone = toxicity_scores(table, labels, row_col=ROW).where("predicted = 1").select(ROW)
    return table.join(gone, ROW, "left_anti").select(*docs.columns)
