"""Quality scores from random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every word has a sparse random index vector; its word vector is the sum of the
index vectors of its neighbours over all documents.  Words are hashed to WORDS
numbers, so that a table of vectors has a fixed size, which the tables of all
partitions are added up to.  A document is the mean and spread of its words'
vectors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import squeezed, unsqueezed
from .common import columns_of, crc_remainder, rows, save
from .toxicity import _Kept, labelled

#: Numbers of words, length of vectors, places of an index vector that are not 0 (the first half 1, the others -1), neighbours on each side.
WORDS, DIM, MARKS, NEAR = 1 << 16, 48, 6, 2
PER_LABEL = 3000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 64, 0.003
THRESHOLD = 0.7
#: Tables that are added at a time; tokens after which a task adds up what it holds.
FAN_IN, HELD = 16, 1 << 20
_TOKEN = re.compile(r"\w+|[^\w\s]+")


@lru_cache(1)
def marks() -> np.ndarray:
    """The places of each word's index vector that are not 0."""
    return np.argsort(np.random.default_rng(11).random((WORDS, DIM), dtype=np.float32), axis=1)[:, :MARKS].astype(np.int32)


def index_vectors() -> np.ndarray:
    out = np.zeros((WORDS, DIM), np.float32)
    for j in range(MARKS):
        out[np.arange(WORDS), marks()[:, j]] = 1 if j < MARKS // 2 else -1
    return out


def _number(token: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace")) % WORDS


def _tokens(text: str | None, known: _Kept) -> np.ndarray:
    found = _TOKEN.findall(text or "")
    return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def _sums_of(documents: list[np.ndarray]) -> np.ndarray:
    """For every word the sum of its neighbours' index vectors within the documents, as a flat table."""
    empty = np.full(NEAR, -1)  # keeps documents apart
    b = np.concatenate([x for d in documents for x in (d, empty)])
    out = np.zeros(WORDS * DIM)
    for gap in range(1, NEAR + 1):
        one, two = b[:-gap], b[gap:]
        real = (one >= 0) & (two >= 0)
        one, two = one[real], two[real]
        for word, other in ((one, two), (two, one)):
            for j in range(MARKS):
                sums = np.bincount(word * DIM + marks()[other, j], minlength=WORDS * DIM)
                out += sums if j < MARKS // 2 else -sums
    return out


def _packed(sums: np.ndarray) -> bytes:
    """Sums as whole numbers, the sign in the lowest bit, compressed."""
    x = sums.astype(np.int64)
    return squeezed(np.abs(x) * 2 + (x < 0))


def _unpacked(blob: bytes) -> np.ndarray:
    x = unsqueezed(blob).astype(np.int64)
    return np.where(x & 1, -(x >> 1), x >> 1)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's neighbour sums, as one table of vectors."""
    from pyspark import TaskContext

    known, total, held, size = _Kept(_number), np.zeros(WORDS * DIM), [], 0
    for batch in batches:
        for (text,) in rows(batch, "text"):
            held.append(_tokens(text, known))
            size += len(held[-1])
            if size >= HELD:
                total += _sums_of(held)
                held, size = [], 0
    if size:
        total += _sums_of(held)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_packed(total)], pa.binary())], ["part", "sums"])


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(WORDS * DIM, np.int64)
    for x in table["sums"]:
        total += _unpacked(x.as_py())
    # beyond 31 bits all sums of the table are scaled, as only their directions count
    while np.abs(total).max() >= 1 << 31:
        total //= 2
    return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int64()), "sums": pa.array([_packed(total)], pa.binary())})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all words' numbers over all documents, a unit vector of the sums plus one of the index: partitions' tables are added FAN_IN at a time."""
    sums = docs.select("text").mapInArrow(_contexts, "part long, sums binary")
    while True:
        sums = save(sums.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_added, "part long, sums binary"))
        if sums.count() <= 1:
            break
    found = sums.collect()  # one table of a fixed size
    total = (_unpacked(found[0]["sums"]) if found else np.zeros(WORDS * DIM)).reshape(WORDS, DIM)
    return (total / np.maximum(1e-9, np.linalg.norm(total, axis=1, keepdims=True)) + index_vectors() / np.sqrt(MARKS)).astype(np.float32)


def pooled(b: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, log of their number, and the share of distinct ones."""
    if not len(b):
        return np.zeros(2 * DIM + 2, np.float32)
    used, n = np.unique(b, return_counts=True)
    v = vectors[used]
    mean = n @ v / len(b)
    spread = np.sqrt(np.maximum(0, n @ v**2 / len(b) - mean**2))
    return np.concatenate([mean, spread, [np.log1p(len(b)) / 8, len(used) / len(b)]]).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, priors: dict[int, float], seed: int = 5) -> dict[str, np.ndarray]:
    """A two-layer network, and the temperature that fits a fifth of the rows that it did not learn from."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, own = order[: len(order) // 5], order[len(order) // 5 :]
    centre, scale = x[own].mean(0), x[own].std(0) + 1e-3
    x = (x - centre) / scale
    share = np.bincount(y, minlength=2) / len(y)
    balance = np.array([priors.get(c, 0) / share[c] if share[c] else 0 for c in (0, 1)])
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 0.2, (HIDDEN, 2)), "b2": np.zeros(2)}
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        rng.shuffle(own)
        for a in range(0, len(own), BATCH):
            i = own[a : a + BATCH]
            h = np.maximum(0, x[i] @ p["w1"] + p["b1"])
            z = h @ p["w2"] + p["b2"]
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(len(i)), y[i]] -= 1
            q *= (balance[y[i]] / len(i))[:, None]
            back = (q @ p["w2"].T) * (h > 0)
            t += 1
            for k, g in (("w1", x[i].T @ back + 1e-3 * p["w1"]), ("b1", back.sum(0)), ("w2", h.T @ q), ("b2", q.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                p[k] -= RATE * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    p |= {"centre": centre, "scale": scale, "heat": np.ones(1)}
    if len(held):
        z = np.maximum(0, x[held] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
        gap, sign, w = z[:, 1] - z[:, 0], np.where(y[held] == 1, 1, -1), balance[y[held]]
        heats = np.exp(np.linspace(-1.5, 1.5, 61))
        p["heat"] = heats[[int(np.argmin([(w * np.logaddexp(0, -sign * gap / t)).sum() for t in heats]))]]
    return p


def probability(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    z = np.maximum(0, (x - p["centre"]) / p["scale"] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
    return 1 / (1 + np.exp(-np.clip((z[:, 1] - z[:, 0]) / p["heat"], -700, 700)))


def quality_scores(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    The score comes from the text alone; null and empty texts are scored by
    their missing words.  Without labelled rows every score is 0.  Repeated rows
    and null ids are scored like any other; other columns are not read.
    """
    source = columns_of(docs, "doc_id", "text")
    vectors = word_vectors(source)
    sample, priors = labelled(source, labels, "quality", per_label)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Kept(_number)
        for batch in batches:
            x = [pooled(_tokens(t, known), vectors).tobytes() for (t,) in rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.binary())], ["label", "x"])

    def fit(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, 2 * DIM + 2).astype(float)
        p = train(x, table["label"].to_numpy().astype(np.int64), priors)
        return pa.table({"name": list(p), "value": pa.array([a.ravel().tolist() for a in p.values()], pa.list_(pa.float64()))})

    fitted = sample.mapInArrow(features, "label int, x binary").groupBy(F.lit("all")).applyInArrow(fit, "name string, value array<double>").collect()  # of a fixed size
    p = {r["name"]: np.array(r["value"]) for r in fitted}
    if p:
        p["w1"], p["w2"] = p["w1"].reshape(-1, HIDDEN), p["w2"].reshape(HIDDEN, 2)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Kept(_number)
        for batch in batches:
            x = [pooled(_tokens(t, known), vectors) for (t,) in rows(batch, "text")]
            out = probability(np.array(x, float), p) if p and x else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
