"""Document log-likelihoods from a gated recurrent language model.

The network is trained in numpy by truncated backpropagation on all training
documents: from shared weights each partition learns from its own documents,
and the weights are averaged by tokens, for a few rounds.  The softmax is
factored into a class and a word within the class, and the state is carried
from window to window, so that a document is scored whole.  It knows the most
frequent words of all training documents; any other word is one class of its
own, times the word's share among such words.  Word counts are gathered from all
training documents by the blocks' shuffle of distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, in_blocks, squeezed, unlisted, unsqueezed
from .common import columns_of, crc_remainder, rows, save, word_array

#: Words that the network knows, its classes, the sizes of vectors and state.
KNOWN, CLASSES, INPUT, STATE = 2047, 32, 16, 24
#: Rounds in which each training document is learned from once; weights are averaged after each.
ROUNDS = 4
LANES, WINDOW, RATE = 512, 24, 0.01
#: Training tokens after which a stream of whole documents ends, and the least updates from a stream.
STREAM, UPDATES = 400_000, 32
#: Documents scored side by side, and steps whose states are kept.
SIDE, STEPS = 1024, 16
SMOOTH = 0.1
#: Lists of frequent words, and partitions' weights, that are merged at a time.
FAN_IN = 64
END = b"\n"  # no word holds it
PER = -(-(KNOWN + 1) // CLASSES)
RARE, START = KNOWN + 1, KNOWN + 2


# Arrays are features x tokens: sums over features then run along memory.


def _new(rng: np.random.Generator) -> dict[str, np.ndarray]:
    g = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    return {"e": g(START + 1, INPUT), "wx": g(INPUT, 3 * STATE), "b": np.zeros(3 * STATE, np.float32), "u": g(STATE, 3 * STATE), "wc": g(STATE, CLASSES + 1), "bc": np.zeros(CLASSES + 1, np.float32), "ww": g(CLASSES, STATE, PER), "bw": np.zeros((CLASSES, PER), np.float32)}


def _sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    # by tanh, which neither overflows nor divides
    x = np.tanh(x * np.float32(0.5), out=out)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def _halves(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The recurrent weights of the gates, and those of the candidate, each transposed."""
    return np.ascontiguousarray(u[:, : 2 * STATE].T), np.ascontiguousarray(u[:, 2 * STATE :].T)


def _step(x3: np.ndarray, h: np.ndarray, ug: np.ndarray, un: np.ndarray, gates: np.ndarray | None = None, new: np.ndarray | None = None, out: np.ndarray | None = None):
    zr = _sigmoid(x3[: 2 * STATE] + ug @ h, out=gates)
    n = np.tanh(x3[2 * STATE :] + un @ (zr[STATE:] * h), out=new)
    return np.add(n, zr[:STATE] * (h - n), out=out)


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return x


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of each column of x at one place."""
    x -= x.max(0)
    own = x[at, np.arange(len(at))]
    return own - np.log(np.exp(x, out=x).sum(0))


def _classes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Targets ordered by class: the order, their classes, and (class, first, end) of each class of known words."""
    c = np.where(y == RARE, CLASSES, y // PER).astype(np.uint8)
    order = np.argsort(c, kind="stable")
    c = c[order]
    bounds = np.searchsorted(c, np.arange(CLASSES + 1)).tolist()
    return order, c, [(k, a, b) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]


def _outputs(h: np.ndarray, y: np.ndarray, p: dict[str, np.ndarray], at: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of each target given the state before it (a column of h, or that at a place of at)."""
    order, c, groups = _classes(y)
    h, y = h[:, order if at is None else at[order]], y[order]
    sums = _log_share(p["wc"].T @ h + p["bc"][:, None], c)
    for k, a, b in groups:
        sums[a:b] += _log_share(p["ww"][k].T @ h[:, a:b] + p["bw"][k][:, None], y[a:b] % PER)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def first_weights(counts: np.ndarray, rest: int, seed: int = 9) -> dict[str, np.ndarray]:
    """Weights whose biases give every known word (the end first), and all other words together, their share of the training tokens."""
    p = _new(np.random.default_rng(seed))
    share = np.full(CLASSES * PER, SMOOTH)
    share[: len(counts)] += counts
    share = share.reshape(CLASSES, PER)
    each = np.append(share.sum(1), rest + SMOOTH)
    p["bc"], p["bw"] = np.log(each / each.sum()).astype(np.float32), np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return p | {"wc": p["wc"] / 10, "ww": p["ww"] / 10}


def _gradients(x: np.ndarray, y: np.ndarray, real: np.ndarray, h: np.ndarray, p: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the negative log-probability of targets y after inputs x (lanes x steps) from the states h, and the states after them.

    The state starts anew where x is START; where real is false nothing is taught.
    """
    lanes, steps = x.shape
    at = x.T.ravel()  # step by step
    fresh = (at != START).astype(np.float32).reshape(steps, lanes)
    read = p["e"][at]
    inputs = p["wx"].T @ read.T + p["b"][:, None]
    ug, un = _halves(p["u"])
    past, gates, news, after = (np.empty((steps, n, lanes), np.float32) for n in (STATE, 2 * STATE, STATE, STATE))
    for s in range(steps):
        h = _step(inputs[:, s * lanes : (s + 1) * lanes], np.multiply(h, fresh[s], out=past[s]), ug, un, gates[s], news[s], after[s])
    flat = lambda z: z.transpose(1, 0, 2).reshape(z.shape[1], -1)
    g = {}
    targets = y.T.ravel()
    order, c, groups = _classes(targets)
    states, targets, taught = flat(after)[:, order], targets[order], real.T.ravel()[order].astype(np.float32)
    q = _softmax(p["wc"].T @ states + p["bc"][:, None])
    q[c, np.arange(len(c))] -= 1
    q *= taught
    g["wc"], g["bc"], back = states @ q.T, q.sum(1), p["wc"] @ q
    g["ww"], g["bw"] = np.zeros_like(p["ww"]), np.zeros_like(p["bw"])
    for k, a, b in groups:
        q = _softmax(p["ww"][k].T @ states[:, a:b] + p["bw"][k][:, None])
        q[targets[a:b] % PER, np.arange(b - a)] -= 1
        q *= taught[a:b]
        g["ww"][k], g["bw"][k] = states[:, a:b] @ q.T, q.sum(1)
        back[:, a:b] += p["ww"][k] @ q
    dh = np.empty_like(back)
    dh[:, order] = back
    ins, back = np.empty((steps, 3 * STATE, lanes), np.float32), np.zeros((STATE, lanes), np.float32)
    for s in range(steps - 1, -1, -1):
        before, z, r, n = past[s], gates[s, :STATE], gates[s, STATE:], news[s]
        d = dh[:, s * lanes : (s + 1) * lanes] + back
        dz = d * z
        dn = np.multiply(d - dz, 1 - n * n, out=ins[s, 2 * STATE :])
        np.multiply(dz * (before - n), 1 - z, out=ins[s, :STATE])
        reset = (un.T @ dn) * r
        np.multiply(reset * before, 1 - r, out=ins[s, STATE : 2 * STATE])
        back = (dz + reset + ug.T @ ins[s, : 2 * STATE]) * fresh[s]
    ins, past, r = flat(ins), flat(past), flat(gates[:, STATE:])
    g["u"] = np.concatenate([past @ ins[: 2 * STATE].T, (r * past) @ ins[2 * STATE :].T], 1)
    g["wx"], g["b"] = read.T @ ins.T, ins.sum(1)
    g["e"] = np.stack([np.bincount(at, row, START + 1) for row in p["wx"] @ ins], 1).astype(np.float32)
    return g, h


def train(streams: Iterator[np.ndarray], start: dict[str, np.ndarray], rate: float) -> tuple[dict[str, np.ndarray], int]:
    """One pass of truncated backpropagation from the weights of start: new weights, and the tokens learned from.

    A stream is documents end to end, dealt to lanes; the state starts anew at each document.
    """
    p = {k: a.copy() for k, a in start.items()}
    m, v, t, tokens = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0, 0
    for stream in streams:
        tokens += len(stream)
        lanes = max(1, min(LANES, len(stream) // (UPDATES * WINDOW)))
        size = -(-len(stream) // (lanes * WINDOW)) * WINDOW
        y = np.full(lanes * size, RARE)
        y[: len(stream)] = stream
        real = (np.arange(len(y)) < len(stream)).reshape(lanes, size)  # what follows fills the last lanes and teaches nothing
        y = y.reshape(lanes, size)
        x = np.concatenate([np.full((lanes, 1), START), y[:, :-1]], 1)
        x = np.where(x == 0, START, x)  # 0 is the end: the next token begins a document
        h = np.zeros((STATE, lanes), np.float32)
        for a in range(0, size, WINDOW):
            own = slice(a, a + WINDOW)
            g, h = _gradients(x[:, own], y[:, own], real[:, own], h, p)
            t += 1
            norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            for k in p:
                q = g[k] * np.float32(min(1.0, 50 / (norm + 1e-9)) / lanes)
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.99 * v[k] + 0.01 * q * q
                p[k] -= (rate * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return p, tokens


def log_likelihoods(documents: list[np.ndarray], p: dict[str, np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document's tokens (an end last), each document whole."""
    total = np.zeros(len(documents))
    inputs, (ug, un) = np.ascontiguousarray((p["e"] @ p["wx"] + p["b"]).T), _halves(p["u"])
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    for a in range(0, len(order), SIDE):
        own = order[a : a + SIDE]
        sizes = np.array([len(documents[i]) for i in own])
        h, last = np.zeros((STATE, len(own)), np.float32), np.full(len(own), START)
        for b in range(0, int(sizes[0]), STEPS):
            live = int((sizes > b).sum())  # longest first
            steps = min(STEPS, int(sizes[0]) - b)
            h, last = np.ascontiguousarray(h[:, :live]), last[:live]
            y = np.zeros((live, steps), np.int64)
            for j in range(live):
                part = documents[own[j]][b : b + steps]
                y[j, : len(part)] = part
            x = np.concatenate([last[:, None], y[:, :-1]], 1)
            states, x3 = np.empty((steps, STATE, live), np.float32), np.take(inputs, x.T.ravel(), axis=1)
            for s in range(steps):
                h = _step(x3[:, s * live : (s + 1) * live], h, ug, un, out=states[s])
            last = y[:, -1]
            step, at = np.nonzero((np.arange(steps) < (sizes[:live] - b)[:, None]).T)
            logs = _outputs(states.transpose(1, 0, 2).reshape(STATE, -1), y[at, step], p, step * live + at)
            total[own[:live]] += np.bincount(at, logs, live)
    return total


def _count(table: pa.Table) -> pa.Table:
    """A bucket's messages with the words' counts over all blocks; the first row also has the bucket's totals and most frequent words."""
    messages = [(unlisted(w.as_py()), unsqueezed(c.as_py()).tolist()) for w, c in zip(table["words"], table["counts"])]
    total: dict[bytes, int] = {}
    for words, counts in messages:
        for w, c in zip(words, counts):
            total[w] = total.get(w, 0) + c
    n = len(messages)
    top = sorted(((c, w) for w, c in total.items() if c), key=lambda x: (-x[0], x[1]))[:KNOWN]
    return pa.table({
        "block": table["block"], "bucket": table["bucket"], "words": table["words"],
        "counts": pa.array([squeezed(np.fromiter((total[w] for w in words), np.uint32, len(words))) for words, _ in messages], pa.binary()),
        "tokens": pa.array([sum(total.values())] + [0] * (n - 1), pa.int64()), "distinct": pa.array([sum(c > 0 for c in total.values())] + [0] * (n - 1), pa.int64()),
        "top_words": pa.array([[w for _, w in top]] + [[]] * (n - 1), pa.list_(pa.binary())), "top_counts": pa.array([[c for c, _ in top]] + [[]] * (n - 1), pa.list_(pa.int64())),
    })


def _merged(table: pa.Table) -> pa.Table:
    """The most frequent words of several lists, as one list."""
    every = sorted(((c, w) for words, counts in zip(table["top_words"].to_pylist(), table["top_counts"].to_pylist()) for w, c in zip(words, counts)), key=lambda x: (-x[0], x[1]))[:KNOWN]
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py() // FAN_IN], pa.int32()), "top_words": pa.array([[w for _, w in every]], pa.list_(pa.binary())), "top_counts": pa.array([[c for c, _ in every]], pa.list_(pa.int64()))})


def _streams(turn: int):
    """Numbered blocks to streams: of each block the counted documents whose turn it is, each whole, in a random order."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        rng, held, size = np.random.default_rng(9), [], 0
        for batch in batches:
            for sizes, counted, ids in rows(batch, "sizes", "counted", "ids", step=1):
                numbers, ends = np.frombuffer(ids, "<u2"), np.cumsum(sizes)
                for i in rng.permutation(np.flatnonzero(counted)[turn::ROUNDS]).tolist():
                    held.append(numbers[ends[i] - sizes[i] : ends[i]])
                    size += sizes[i]
                    if size >= STREAM:
                        yield np.concatenate(held).astype(np.int64)
                        held, size = [], 0
        if held:
            yield np.concatenate(held).astype(np.int64)

    return made


def _learn(p: dict[str, np.ndarray], rate: float, turn: int):
    """A partition's numbered blocks to its weights times its tokens."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        new, tokens = train(_streams(turn)(batches), p, rate)
        if tokens:
            sums = np.concatenate([a.ravel() for a in new.values()]).astype(np.float64) * tokens
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([tokens], pa.int64()), pa.array([sums.tobytes()], pa.binary())], ["part", "tokens", "sums"])

    return learn


def _added(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    total = sum(np.frombuffer(x.as_py()) for x in table["sums"])
    return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int64()), "tokens": pa.array([sum(table["tokens"].to_pylist())], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def fit(numbered: DataFrame, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Weights after ROUNDS rounds over numbered blocks (sizes, counted, ids), starting from p."""
    schema = "part long, tokens long, sums binary"
    for turn in range(ROUNDS):
        sums = save(numbered.select("sizes", "counted", "ids").mapInArrow(_learn(p, RATE * (1 - turn / ROUNDS), turn), schema))
        while sums.count() > 1:  # added FAN_IN at a time, down to one
            sums = save(sums.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_added, schema))
        for row in sums.collect():  # of a fixed size
            flat = np.frombuffer(row["sums"]) / row["tokens"]
            cuts = np.cumsum([a.size for a in p.values()])[:-1]
            p = {k: x.reshape(a.shape).astype(a.dtype) for (k, a), x in zip(p.items(), np.split(flat, cuts))}
    return p


NUMBERED = "doc_ids array<long>, sizes array<long>, counted array<boolean>, known array<long>, base array<double>, rest array<double>, ids binary"


def lm_scores(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id as text) mod 10 is not 0.  A null or
    empty text is its end alone.  Words are told by their bytes after A-Z is
    lower-cased.  Repeated rows and null ids (as an empty text under crc32) are
    scored like any other; other columns are not read.  An empty table gives an
    empty result.
    """
    source = columns_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("counted", crc_remainder("doc_id", 10) != 0)
    words, placed, buckets = in_blocks(source, word_array, block_chars)
    answers = save(words.groupBy("bucket").applyInArrow(_count, "block long, bucket int, words binary, counts binary, tokens long, distinct long, top_words array<binary>, top_counts array<long>"))
    ends = source.where("counted").count()
    sums = answers.agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    tokens, distinct = (sums["n"] or 0) + ends, (sums["v"] or 0) + (ends > 0)
    lists = answers.where(F.size("top_words") > 0).select("bucket", "top_words", "top_counts")
    while buckets >= 1:  # lists are merged FAN_IN at a time, down to one
        lists, buckets = lists.groupBy(F.floor(F.col("bucket") / FAN_IN)).applyInArrow(_merged, "bucket int, top_words array<binary>, top_counts array<long>"), 0 if buckets <= FAN_IN else -(-buckets // FAN_IN)
    top = lists.collect()  # one list of at most KNOWN words
    # 0 is the end, then words by frequency
    known = {bytes(w): i for i, w in enumerate(top[0]["top_words"] if top else (), start=1)}
    rest_tokens, rest_distinct = tokens - ends - sum(top[0]["top_counts"] if top else ()), distinct - (ends > 0) - len(known)

    def number(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's documents as word numbers, an end after each, with all that the counts tell of them."""
        replies = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        own = [w for r in replies for w in unlisted(r["words"])]
        count = np.concatenate([np.zeros(0, np.int64), *(unsqueezed(r["counts"]).astype(np.int64) for r in replies)])
        numbers = np.fromiter((known.get(w, RARE) for w in own), np.uint16, len(own))
        base = np.log10((count + SMOOTH) / (tokens + SMOOTH * (distinct + 1)))
        rare = np.where(numbers == RARE, np.log10((count + SMOOTH) / (rest_tokens + SMOOTH * (rest_distinct + 1))), 0)
        end = np.log10((ends + SMOOTH) / (tokens + SMOOTH * (distinct + 1)))
        out = []
        for row in left.to_pylist():
            if row["distinct"] != len(own):
                raise RuntimeError("the words of a block are incomplete")
            at, sizes = unsqueezed(row["places"])[unsqueezed(row["numbers"])], np.array(row["sizes"], np.int64)
            stops = np.cumsum(sizes)
            total = lambda x: np.diff(np.append(0, np.cumsum(x[at]))[np.append(0, stops)])
            out.append({"doc_ids": row["doc_ids"], "sizes": sizes + 1, "counted": row["counted"], "known": total(count > 0) + (ends > 0), "base": total(base) + end, "rest": total(rare), "ids": np.insert(numbers[at], stops, 0).astype("<u2").tobytes()})
        return pa.table({n: pa.array([r[n] for r in out], t) for n, t in (("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("counted", pa.list_(pa.bool_())), ("known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("rest", pa.list_(pa.float64())), ("ids", pa.binary()))})

    numbered = save(placed.groupBy("block").cogroup(answers.select("block", "bucket", "words", "counts").groupBy("block")).applyInArrow(number, NUMBERED))
    p = fit(numbered, first_weights(np.array([ends, *(top[0]["top_counts"] if top else ())]), rest_tokens))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, sizes, seen, base, rest, ids in rows(batch, "doc_ids", "sizes", "known", "base", "rest", "ids", step=1):
                parts = np.split(np.frombuffer(ids, "<u2").astype(np.int64), np.cumsum(sizes)[:-1])
                scores = log_likelihoods(parts, p) / np.log(10) + np.array(rest)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(seen, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    scored = numbered.mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", (crc_remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
