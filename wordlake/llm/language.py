"""Language of documents by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; what is no letter is a boundary.  n-grams of one to four
characters that hold a letter, within words and over their ends, are hashed to
BUCKETS numbers.  Document frequencies come from all training documents.  The
regression is learned by follow-the-regularised-leader with an L1 and an L2
penalty, a document at a time, and a temperature is fitted to a fifth of the
sample.  A text's term frequencies are shares of its n-grams, so its logits are
a mean over its n-grams, which is summed in slices, whatever the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import squeezed, unsqueezed
from .common import columns_of, crc_remainder, rows, save

#: Numbers of n-grams (as a power of two) and the longest n-gram.
BITS, LONGEST = 16, 4
BUCKETS = 1 << BITS
#: Training documents of each language at most, by the order of their hashes.
PER_LANG = 1500
#: How many times the wanted rows are looked at to find those of the least hashes.
SPARE = 2
EPOCHS, SCALE = 2, 100.0
#: Of the learning: step size, its damping, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 0.1, 1.0, 0.5, 1.0
#: Characters of a text that are worked on at a time.
SLICE = 1 << 20
#: Tables of document frequencies that are added at a time.
FAN_IN = 16
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _pieces(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of the lower-cased text between two boundaries, 0 where there is no letter, a slice at a time with what n-grams reach beyond it; and how many n-grams may start there."""
    text = text.lower()
    size = len(text) + 2
    for a in range(0, size, SLICE):
        b = min(size, a + SLICE + LONGEST - 1)
        c = np.frombuffer(text[max(0, a - 1) : min(len(text), b - 1)].encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(_letters()[c], c, 0).astype(np.uint32)
        yield np.concatenate([np.zeros(int(a == 0), np.uint32), c, np.zeros(int(b == size), np.uint32)]), min(SLICE, size - a)


def grams(text: str) -> Iterator[np.ndarray]:
    """The buckets of the text's n-grams, by slice and length; none if there is no letter."""
    for c, starts in _pieces(text):
        letter, h = c != 0, np.ones(len(c), np.uint32)
        for n in range(1, LONGEST + 1):
            size = min(starts, len(c) - n + 1)
            if size <= 0:
                break
            h = h[: len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1 :]  # of the n characters from each place on
            # a boundary may only stand at an end, and not at both ends of two
            inner = letter[:size] if n == 1 else letter[:size] | letter[1 : 1 + size] if n == 2 else letter[1 : 1 + size]
            for j in range(2, n - 1):
                inner = inner & letter[j : j + size]
            g = h[:size][inner]
            g ^= g >> np.uint32(15)
            g *= np.uint32(0x9E3779B1)
            yield (g >> np.uint32(32 - BITS)).astype(np.int64)


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs."""
    out = np.zeros(BUCKETS, np.int64)
    for g in grams(text):
        out += np.bincount(g, minlength=BUCKETS)
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's number of documents that hold each bucket, and of documents, as one table."""
    from pyspark import TaskContext

    total, seen = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS, bool)
    for batch in batches:
        for (text,) in rows(batch, "text"):
            seen[:] = False
            for g in grams(text):
                seen[g] = True
            total[:-1] += seen
            total[-1] += 1
    if total[-1]:
        yield _table(TaskContext.get().partitionId(), total)


def _table(part: int, total: np.ndarray) -> pa.RecordBatch:
    halves = [squeezed(total >> 32), squeezed(total & 0xFFFFFFFF)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([halves[0]], pa.binary()), pa.array([halves[1]], pa.binary())], ["part", "high", "low"])


def _sum(highs, lows) -> np.ndarray:
    total = np.zeros(BUCKETS + 1, np.int64)
    for high, low in zip(highs, lows):
        total += (unsqueezed(high).astype(np.int64) << 32) + unsqueezed(low)
    return total


def _added(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_table(table["part"][0].as_py() // FAN_IN, _sum(table["high"].to_pylist(), table["low"].to_pylist()))])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Over all texts of docs (none null): the number of documents that hold each bucket, and at the end the number of documents."""
    parts = docs.select("text").mapInArrow(_frequencies, "part long, high binary, low binary")
    while True:
        parts = save(parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_added, "part long, high binary, low binary"))
        if parts.count() <= 1:
            break
    found = parts.collect()  # one table of a fixed size
    return _sum([r["high"] for r in found], [r["low"] for r in found])


def inverse(frequencies: np.ndarray) -> np.ndarray:
    """The smoothed inverse document frequency of each bucket."""
    return np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and their shares of each text that has a letter."""
    for batch in batches:
        lang, at, share = [], [], []
        for name, text in rows(batch, "lang", "text"):
            n = counts(text)
            used = np.flatnonzero(n)
            if len(used):
                lang.append(name), at.append(used.astype("<u4").tobytes()), share.append((n[used] / n.sum()).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.binary()), pa.array(share, pa.binary())], ["lang", "at", "share"])


class Leader:
    """Follow-the-regularised-leader: per bucket and language the sum of squared slopes and the dual sum; weights follow from them, many being 0."""

    def __init__(self, buckets: int, langs: int):
        self.z, self.n = np.zeros((buckets + 1, langs)), np.zeros((buckets + 1, langs))  # the last row is the bias, without penalties

    def weights(self, at) -> np.ndarray:
        z, root = self.z[at], np.sqrt(self.n[at])
        w = -(z - np.sign(z) * L1) / ((BETA + root) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0, w)

    def bias(self) -> np.ndarray:
        return -self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int, weight: float) -> None:
        w, b = self.weights(at), self.bias()
        slope = softmax(x @ w + b)
        slope[y] -= 1
        slope *= weight
        for rows_, g, was in ((at, x[:, None] * slope, w), (-1, slope, b)):
            n = self.n[rows_] + g**2
            self.z[rows_] += g - (np.sqrt(n) - np.sqrt(self.n[rows_])) / ALPHA * was
            self.n[rows_] = n


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(-1, keepdims=True))
    return p / p.sum(-1, keepdims=True)


def train(docs: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, priors: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of a text's shares of n-grams (buckets x languages), biases, temperature, from documents (language, buckets, shares).

    Documents count so that languages have the shares they have among all
    training documents.  The temperature is the best of a range for a fifth of
    the documents, which the weights do not learn from.
    """
    order = np.random.default_rng(seed).permutation(len(docs))
    held, own = order[: len(docs) // 5], order[len(docs) // 5 :]
    share = np.bincount([y for y, _, _ in docs], minlength=len(priors)) / len(docs)
    balance = np.where(share > 0, priors / np.maximum(share, 1e-12), 0)
    model = Leader(len(idf), len(priors))
    for _ in range(EPOCHS):
        for i in own:
            y, at, tf = docs[i]
            model.learn(at, tf * idf[at] * SCALE, y, balance[y])
    weights, bias, heat = model.weights(slice(0, -1)), model.bias(), 1.0
    if len(held):
        z = np.array([(docs[i][2] * idf[docs[i][1]] * SCALE) @ weights[docs[i][1]] + bias for i in held])
        y = np.array([docs[i][0] for i in held])
        heats = np.exp(np.linspace(-3, 3, 121))
        loss = [-(balance[y] * np.log(np.maximum(1e-300, softmax(z / t)[np.arange(len(y)), y]))).sum() for t in heats]
        heat = float(heats[int(np.argmin(loss))])
    return weights * idf[:, None] * SCALE, bias, heat


def logits(text: str, weights: np.ndarray, bias: np.ndarray) -> np.ndarray | None:
    """The languages' logits, or None for a text without a letter; weights: buckets x languages."""
    total, n = np.zeros(weights.shape[1]), 0
    for g in grams(text):
        n += len(g)
        for a in range(0, len(g), 1 << 12):  # short sums, as they are made in single precision
            own = np.take(weights, g[a : a + (1 << 12)], axis=0)
            total += np.ones(len(own), np.float32) @ own
    return total / n + bias if n else None


def sampled(known: DataFrame, shares: dict[str, float], per_lang: int) -> DataFrame:
    """(lang, text): of each language the per_lang distinct rows of the least hashes.

    Rows beyond a share of the hashes' range, which leaves SPARE times as many as
    wanted, are dropped before languages are gathered, so a large language costs
    no task more than a small one.
    """
    tight = {x: s for x, s in shares.items() if s < 1}
    bound = F.create_map(*[F.lit(y) for x, s in tight.items() for y in (x, int(s * 2**64) - 2**63)])[F.col("lang")] if tight else F.lit(None).cast("long")
    few = known.where(bound.isNull() | (F.col("__hash") < bound)).groupBy("lang", "__hash").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("__hash")
    return few.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= per_lang).select("lang", "text")


def languages(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Learned from are text and lang, both not null, of rows whose crc32(doc_id
    as text) mod 4 is not 2: document frequencies from all of them, weights from
    at most per_lang distinct (doc_id, text) of each language, in the order of
    their hashes (texts without a letter teach nothing).  A null text and one
    without a letter are `und` with a score of 0; so is every text if there is
    nothing to learn from.  The score is the calibrated probability of lang_pred.
    Repeated rows and null ids are scored like any other; other columns are not
    read.  Runs jobs when called.
    """
    source = columns_of(docs, "doc_id", "text", "lang")
    known = source.where((crc_remainder("doc_id", 4) != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull()).withColumn("__hash", F.xxhash64("doc_id", "text"))
    sizes = {r["lang"]: (r["n"], r["distinct"]) for r in known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("__hash").alias("distinct")).collect()}  # a row a language
    langs = sorted(sizes)
    priors = np.array([sizes[x][0] for x in langs]) / max(1, sum(n for n, _ in sizes.values()))
    frequencies = document_frequencies(known)
    sample = sampled(known, {x: SPARE * per_lang / max(1, d) for x, (_, d) in sizes.items()}, per_lang)
    number = {x: i for i, x in enumerate(langs)}
    idf = inverse(frequencies)

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("at", "ascending"), ("share", "ascending")])  # so that the partitions' order does not matter
        own = [(number[x], np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(s, np.float32).astype(float)) for x, a, s in zip(table["lang"].to_pylist(), table["at"].to_pylist(), table["share"].to_pylist())]
        weights, bias, heat = train(own, idf, priors)
        return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()), "bias": pa.array([bias.tolist()], pa.list_(pa.float64())), "heat": pa.array([heat])})

    made = sample.mapInArrow(_features, "lang string, at binary, share binary").groupBy(F.lit("all")).applyInArrow(fit, "weights binary, bias array<double>, heat double").collect()  # a bounded sample, one row of a fixed size a language
    model = (np.frombuffer(made[0]["weights"], np.float32).reshape(BUCKETS, len(langs)), np.array(made[0]["bias"]), made[0]["heat"]) if made else None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = [], []
            for (text,) in rows(batch, "text"):
                z = logits(text, *model[:2]) if model and text else None
                p = softmax(z / model[2]) if z is not None else np.zeros(0)
                found.append(langs[int(p.argmax())] if len(p) else UNKNOWN), score.append(float(p.max(initial=0)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    predicted = source.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return predicted.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
