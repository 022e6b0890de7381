"""Vector codes: whole-number product quantisation whose rounds skip distances by adaptive bounds.

A vector is cut into equal parts, and each part position has a codebook of a
few entries.  A block of vectors keeps, for each part, the entry it has now, its
b next closest entries with ordered lower bounds of their distances, and one
outer bound for all others.  When the entries move, bounds fall by how far;
a part whose own distance lies below its least bound keeps its entry unseen.
Otherwise the entries whose bounds are reached are measured in whole numbers,
and all entries where the outer bound is.  b falls to the most ranks that a
block's part has needed.  The state is a table in the shared folder, one for
each round; codebooks have a fixed size and come from one aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, join_hot, rows, save

#: Parts of a vector, entries of a codebook, rounds of assignment and update, and the factor before components are rounded down.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Ranks kept at first and at least, as shares of the entries.
FIRST_RANKS, LEAST_RANKS = 1 / 8, 1 / 16
#: Components of this size and more count as it, which keeps squared distances within 63 bits.
MOST = 1 << 26
#: Vectors of a block.
BLOCK = 2048
#: Kept lower bounds are whole steps of their block's largest bound.
STEPS = 65_535


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) with v = floor(scale * x), of rows whose vector is not null and holds neither null nor non-finite components."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda e: e.cast("double"))
    good = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform("x", lambda e: F.least(F.greatest(F.floor(e * scale), F.lit(-MOST)), F.lit(MOST)).cast("int"))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), x.alias("x")).where(F.col("x").isNotNull() & good).select("vec_id", "label", v.alias("v"))


def start_codebooks(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Parts x entries x components: the parts of the vectors of the smallest ids, of one length; None without a vector that can be cut."""
    fit = table.where((F.size("v") > 0) & (F.size("v") % parts == 0)).orderBy(F.asc_nulls_last("vec_id"), "v")
    least = fit.limit(entries).collect()
    if least and len({len(r["v"]) for r in least}) > 1:
        least = fit.where(F.size("v") == len(least[0]["v"])).limit(entries).collect()
    return np.array([r["v"] for r in least], np.int64).reshape(len(least), parts, -1).transpose(1, 0, 2) if least else None


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all entries."""
    out = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - book[:, j]) ** 2
    return out


def _below(x: np.ndarray) -> np.ndarray:
    """Distances, rounded down, of squared ones."""
    return np.sqrt(x.astype(np.float64)) * (1 - 1e-12)


class PartState:
    """Of a block's vectors and one part: own entries, the near ones with ordered lower bounds of their distances, the outer bound; measured: distances taken."""

    def __init__(self, own: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.own, self.near, self.low, self.outer, self.measured = own, near, low, outer, 0

    @classmethod
    def measure(cls, x: np.ndarray, book: np.ndarray, ranks: int) -> PartState:
        d = _squares(x, book)
        own = d.argmin(1)  # the first of equal ones
        d[np.arange(len(x)), own] = -1  # stands first below
        ranks = min(ranks, len(book) - 1)
        shown = min(ranks + 2, len(book))
        at = np.argpartition(d, shown - 1, axis=1)[:, :shown]
        far = np.take_along_axis(d, at, 1)
        by = np.argsort(far, axis=1, kind="stable")
        at, far = np.take_along_axis(at, by, 1), _below(np.maximum(0, np.take_along_axis(far, by, 1)))
        outer = far[:, ranks + 1] if shown > ranks + 1 else np.full(len(x), np.inf)
        made = cls(own, at[:, 1 : ranks + 1], far[:, 1 : ranks + 1], outer)
        made.measured = len(x) * len(book)
        return made

    def move(self, x: np.ndarray, old: np.ndarray, new: np.ndarray, least: int) -> None:
        """Entries move from old to new; own entries become the closest again, and at least `least` ranks stay."""
        drift = np.sqrt(((new - old) ** 2).sum(1).astype(np.float64)) * (1 + 1e-12)
        ranks = self.near.shape[1]
        bounds = np.concatenate([self.low - drift[self.near], (self.outer - drift.max(initial=0))[:, None]], 1)
        bounds = np.minimum.accumulate(bounds[:, ::-1], 1)[:, ::-1]  # in order again: a bound holds for all ranks after it
        best = ((x - new[self.own]) ** 2).sum(1)
        self.measured = len(x)
        need = (bounds <= (np.sqrt(best.astype(np.float64)) * (1 + 1e-12))[:, None]).sum(1)
        self.low, self.outer = bounds[:, :ranks].copy(), bounds[:, ranks].copy()
        all_of = np.flatnonzero(need > ranks)
        some = np.flatnonzero((need > 0) & (need <= ranks))
        used = int(need[some].max(initial=0))
        if len(some):
            self._verify(some, x[some], new, best[some], need[some], used)
        if len(all_of):
            again = PartState.measure(x[all_of], new, ranks)
            self.own[all_of], self.near[all_of], self.low[all_of], self.outer[all_of] = again.own, again.near, again.low, again.outer
            self.measured += again.measured
        fewer = max(least, used)
        if fewer < ranks:
            self.near, self.low, self.outer = self.near[:, :fewer], self.low[:, :fewer], np.minimum(self.outer, self.low[:, fewer])

    def _verify(self, at: np.ndarray, x: np.ndarray, book: np.ndarray, best: np.ndarray, need: np.ndarray, used: int) -> None:
        """Measures the first need ranks of the rows at; the entry left goes where the new one came from."""
        own, near, low = self.own[at], self.near[at], self.low[at]
        first, left = own.copy(), best.copy()
        place = np.full(len(at), -1)
        for rank in range(used):
            i = np.flatnonzero(need > rank)
            entry = near[i, rank]
            d = ((x[i] - book[entry]) ** 2).sum(1)
            self.measured += len(i)
            low[i, rank] = _below(d)
            closer = (d < best[i]) | (d == best[i]) & (entry < own[i])
            i = i[closer]
            best[i], own[i], place[i] = d[closer], entry[closer], rank
        i = np.flatnonzero(place >= 0)
        near[i, place[i]], low[i, place[i]] = first[i], _below(left[i])
        by = np.argsort(low, axis=1, kind="stable")
        self.own[at], self.near[at], self.low[at] = own, np.take_along_axis(near, by, 1), np.take_along_axis(low, by, 1)


STATE = "ids array<long>, labels array<{}>, vectors binary, own binary, near binary, low binary, outer binary, steps array<double>, ranks array<int>, sums array<long>, measured long"


def _written(ids: pa.Array, labels: pa.Array, x: np.ndarray, states: list[PartState], entries: int) -> pa.RecordBatch:
    """A block with the state of its parts; bounds are rounded down to steps; sums has, by part and entry, the components' sums and the number."""
    width, sums, packed, steps = x.shape[2], [], [], []
    for p, s in enumerate(states):
        each = [np.bincount(s.own, x[:, p, j], entries) for j in range(width)] + [np.bincount(s.own, minlength=entries)]
        sums.append(np.stack(each, 1).astype(np.int64).ravel())
        finite = np.isfinite(s.outer)
        low, outer = np.maximum(0, s.low), np.where(finite, np.maximum(0, s.outer), 0)
        step = max(low.max(initial=0), outer.max(initial=0)) / STEPS or 1.0
        down = lambda a: np.maximum(0, np.floor(a / step * (1 - 1e-12))).astype("<u2")  # noqa: E731, B023
        packed.append((s.own.astype(np.uint8).tobytes(), s.near.astype(np.uint8).tobytes(), down(low).tobytes(), np.where(finite, np.minimum(down(outer), STEPS - 1), STEPS).astype("<u2").tobytes()))
        steps.append(float(step))
    own, near, low, outer = (b"".join(c) for c in zip(*packed))
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    columns = {"ids": one(ids), "labels": one(labels), "vectors": pa.array([x.astype("<i4").tobytes()], pa.binary()), "own": pa.array([own], pa.binary()), "near": pa.array([near], pa.binary()), "low": pa.array([low], pa.binary()), "outer": pa.array([outer], pa.binary())}
    columns |= {"steps": one(pa.array(steps, pa.float64())), "ranks": one(pa.array([s.near.shape[1] for s in states], pa.int32())), "sums": one(pa.array(np.concatenate(sums))), "measured": pa.array([sum(s.measured for s in states)], pa.int64())}
    return pa.RecordBatch.from_pydict(columns)


def _read(vectors: bytes, own: bytes, near: bytes, low: bytes, outer: bytes, steps: list[float], ranks: list[int], parts: int) -> tuple[np.ndarray, list[PartState]]:
    """The vectors and parts' states of a block."""
    n = len(own) // parts
    x = np.frombuffer(vectors, "<i4").astype(np.int64).reshape(n, parts, -1)
    own, near, low, outer = np.frombuffer(own, np.uint8).reshape(parts, n), np.frombuffer(near, np.uint8), np.frombuffer(low, "<u2"), np.frombuffer(outer, "<u2").reshape(parts, n)
    states, a = [], 0
    for p, (step, b) in enumerate(zip(steps, ranks)):
        states.append(PartState(own[p].astype(np.int64), near[a : a + n * b].reshape(n, b).astype(np.int64), low[a : a + n * b].reshape(n, b) * step, np.where(outer[p] == STEPS, np.inf, outer[p] * step)))
        a += n * b
    return x, states


def _first(books: np.ndarray, ranks: int) -> Callable:
    """Rows (vec_id, label, v) to blocks with their first state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                own = batch.slice(a, BLOCK)
                x = own.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(own.num_rows, len(books), -1)
                yield _written(own.column("vec_id"), own.column("label"), x, [PartState.measure(x[:, p], book, ranks) for p, book in enumerate(books)], books.shape[1])

    return run


_HELD = ("vectors", "own", "near", "low", "outer", "steps", "ranks")


def _next(old: np.ndarray, new: np.ndarray, least: int) -> Callable:
    """Blocks to blocks whose state follows the entries from old to new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, held in enumerate(rows(batch, *_HELD, step=1)):
                x, states = _read(*held, len(new))
                for p, state in enumerate(states):
                    state.move(x[:, p], old[p], new[p], least)
                yield _written(batch.column("ids")[i].values, batch.column("labels")[i].values, x, states, new.shape[1])

    return run


def _coded(old: np.ndarray, new: np.ndarray, least: int) -> Callable:
    """Blocks to rows (vec_id, label, code, error) under the entries of new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, held in enumerate(rows(batch, *_HELD, step=1)):
                x, states = _read(*held, len(new))
                error = np.zeros(len(x), np.int64)
                for p, state in enumerate(states):
                    state.move(x[:, p], old[p], new[p], least)
                    error += ((x[:, p] - new[p][state.own]) ** 2).sum(1)
                codes = np.stack([s.own for s in states], 1).astype(np.uint8).tobytes().hex()
                each = 2 * len(states)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array([codes[k : k + each] for k in range(0, len(codes), each)], pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def _updated(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries as the rounded-down means of their parts; unused ones stay."""
    summed = blocks.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()  # of a fixed size
    total = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), np.int64)
    for r in summed:
        total[r["at"]] = r["n"]
    total = total.reshape(*books.shape[:2], -1)
    count = total[..., -1:]
    return np.where(count > 0, total[..., :-1] // np.maximum(1, count), books)


def encode(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Of whole_vectors(): (vec_id, label, code, error), saved, the final codebooks, and how many distances each assignment but the last measured."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part, so 1 to 256 entries")
    kind = table.schema["label"].dataType.simpleString()
    books = start_codebooks(table, parts, entries)
    if books is None:
        return table.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64), []
    n = books.shape[1]
    least = max(1, round(n * LEAST_RANKS))
    same = table.where(F.size("v") == parts * books.shape[2])
    blocks, old, measured = None, books, []
    for _ in range(rounds):
        if blocks is None:
            made = save(same.mapInArrow(_first(books, max(1, round(n * FIRST_RANKS))), STATE.format(kind)))
        else:
            made = save(blocks.mapInArrow(_next(old, books, least), STATE.format(kind)))
            drop_saved(blocks)
        blocks, old = made, books
        measured.append(blocks.agg(F.sum("measured")).first()[0])
        books = _updated(blocks, books)
    if blocks is None:
        blocks = save(same.mapInArrow(_first(books, max(1, round(n * FIRST_RANKS))), STATE.format(kind)))
    coded = save(blocks.mapInArrow(_coded(old, books, least), f"vec_id long, label {kind}, code string, error long"))
    drop_saved(blocks)
    return coded, books, measured


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept row of vectors (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256.

    Codebooks start as the parts of the vectors of the smallest ids (null ids
    come last, equal ids by their vectors).  Rows that repeat an id are each
    coded.  All vectors must have one length that parts divides: rows of a
    length other than that of the smallest such id are left out, as no codebook
    fits them; so are null, empty, and non-finite vectors.  With fewer rows than
    entries there are fewer entries.  Other columns are not read.  An empty
    table gives an empty result.  Runs jobs when called.
    """
    coded, books, _ = encode(whole_vectors(vectors), parts, entries, rounds)
    key = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    coded = coded.withColumn("__label", key)
    totals = coded.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__n"))
    return join_hot(coded, totals, "__label", "__n").select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
