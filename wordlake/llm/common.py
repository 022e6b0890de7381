"""Helpers that several operators share: the shared folder, text kernels, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z on UTF-8 bytes; bytes of other characters stay as they are.
LOWER = bytes(range(256)).lower()

#: Rows up to which a list of ids may be broadcast (16 bytes each); larger lists are shuffled.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a temporary one on a local master alone."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wordlake-"))
    return context._jsc.sc().getCheckpointDir().get()


def save(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, which cuts its lineage; the files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(java)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Deletes the files of a table made by save() that no later result reads."""
    context = df.sparkSession.sparkContext
    for name in df.inputFiles()[:1]:
        java = context._jvm.org.apache.hadoop.fs.Path(name).getParent()
        if java.getName().startswith("table-"):
            java.getFileSystem(context._jsc.hadoopConfiguration()).delete(java, True)


#: The column of numbered().
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """docs, saved, with a number of each row's own, as ids may be null or repeated."""
    return save(docs.withColumn(ROW, F.monotonically_increasing_id()))


def only_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of df whose id is in ids (null equals null): by broadcast when ids are few, else by a shuffled join."""
    ids = ids.select(F.col(column).alias("__id")).distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, F.col(column).eqNullSafe(F.col("__id")), "left_semi")


#: Rows of a key from which it is joined by broadcast, and keys up to which they may be.
HOT, HOT_KEYS = 10_000, 100_000


def join_hot(left: DataFrame, right: DataFrame, key: str, size: str) -> DataFrame:
    """The inner join with right, which has each key once, with its number of rows in left in size; no task gets all rows of a large key."""
    hot = right.where(F.col(size) > HOT)
    if hot.limit(HOT_KEYS + 1).count() > HOT_KEYS:
        return left.join(right, key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.where(F.col(size) <= HOT), key)
    return left.join(F.broadcast(hot), key).unionByName(rest)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns cannot clash with an operator's own."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def byte_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


class WordHashes(dict):
    """64-bit hash of a word, kept for words seen before; emptied when it has grown large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def crc_remainder(column: str, modulus: int):
    """crc32(id as text) mod modulus; a null id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that an edge (u, v) touches; component is the smallest node reachable.

    Each round points every node at its least neighbour, follows the pointer once
    more and contracts the graph, so the nodes left at least halve.  Nothing is
    collected; labels are joined, and sums per node are pre-aggregated, so a
    node with very many edges costs no more than its edges.
    """
    # saved tables, not checkpoint(): a checkpoint keeps size estimates, which multiply with every join
    both = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    both = save(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))).distinct()
    label = None
    while not both.isEmpty():
        least = save(both.groupBy(F.col("u").alias("a")).agg(F.min("v").alias("v")).select("a", F.least("a", "v").alias("p")))
        up = least.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        point = save(least.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p")))
        drop_saved(least)
        to = lambda side, table=point: table.select(F.col("a").alias(side), F.col("p").alias(f"p{side}"))
        fewer = save(both.join(to("u"), "u").join(to("v"), "v").where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct())
        drop_saved(both)
        both = fewer
        if label is None:
            label = point.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            longer = save(label.join(to("component"), "component", "left").select("node", F.coalesce("pcomponent", "component").alias("component")))
            drop_saved(label), drop_saved(point)
            label = longer
    return label if label is not None else both.select(F.col("u").alias("node"), F.col("v").alias("component"))


@lru_cache(1)
def _any_tokens():
    import public_tokenizers
    import regex

    # \s of the rank files' libraries is Unicode's White_Space, which has no U+001C to U+001F
    return regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


#: Kinds of characters to the pre-token pattern: white space, letter, number, other; texts with characters of no kind here go by the pattern itself.
SPACE, LETTER, NUMBER, OTHER, STRANGE = range(5)
_PLAIN_CHARS = [*range(9, 14), *range(0x20, 0x7F), *range(0xC0, 0x250), *map(ord, "¡«»¿–—‘’“”…")]
_KINDS = np.full(0x2100, STRANGE, np.uint8)
_KINDS[_PLAIN_CHARS] = [SPACE if chr(i).isspace() else LETTER if chr(i).isalpha() else NUMBER if chr(i).isdigit() else OTHER for i in _PLAIN_CHARS]
#: What may follow an apostrophe in a token of its own, by its first letter: the second letter, if any.
_AFTER_APOSTROPHE = {"s": "", "t": "", "m": "", "d": "", "r": "e", "v": "e", "l": "l"}


def _token_starts(c: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the tokens of plain texts start; c: the code points of all texts, kind: theirs, first: where a text starts."""
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last of some white space before a word stands alone, or, if a space, with the word
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    start[last] = True
    start[last[c[last] == 32] + 1] = False
    quote = np.flatnonzero((c == 39) & start)
    for one, two in _AFTER_APOSTROPHE.items():
        size = 1 + len(two)
        at = quote[quote + size < len(c)]
        at = at[(c[at + 1] == ord(one)) & ~first[at + 1]]
        if two:
            at = at[(c[at + 2] == ord(two)) & ~first[at + 2]]
        start[at + 1] = False
        after = at + 1 + size
        after = after[after < len(c)]
        start[after[(kind[after] == LETTER) | first[after]]] = True
    return start


def sliced(data: bytes, starts: np.ndarray) -> pa.Array:
    """data cut at starts (the first is 0), as an Arrow array without copies."""
    offsets = np.append(starts, len(data)).astype(np.int32 if len(data) < 1 << 31 else np.int64)
    return pa.Array.from_buffers(pa.binary() if offsets.dtype == np.int32 else pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def pre_tokens(text: str) -> list[str]:
    """The matches of public_tokenizers.PATTERN in text."""
    return _any_tokens().findall(text)


def pre_token_array(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The matches of public_tokenizers.PATTERN in each text, in UTF-8, end to end, and their numbers."""
    sizes = np.zeros(len(texts), np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    kind = _KINDS[np.minimum(c, len(_KINDS) - 1)]
    ends = np.cumsum(lengths)
    strange = np.diff(np.append(0, np.cumsum(kind == STRANGE))[np.append(0, ends)]) > 0
    if strange.any():
        keep = np.repeat(~strange, lengths)
        c, kind = c[keep], kind[keep]
    own = np.flatnonzero(~strange & (lengths > 0))
    first = np.zeros(len(c), bool)
    begins = np.cumsum(lengths[own]) - lengths[own]
    first[begins] = True
    start = _token_starts(c, kind, first) if len(c) else first
    if len(own):
        sizes[own] = np.add.reduceat(start, begins, dtype=np.int64)
    places = np.cumsum((c > 0x7F).astype(np.int32) + (c > 0x7FF), dtype=np.int64)  # further bytes, up to here
    at = np.flatnonzero(start)
    plain = sliced("".join(texts[i] for i in own.tolist()).encode(), at + np.where(at > 0, places[at - 1], 0) if len(at) else at)
    if not strange.any():
        return plain, sizes
    odd = [[w.encode() for w in pre_tokens(texts[i])] for i in np.flatnonzero(strange).tolist()]
    sizes[strange] = list(map(len, odd))
    every = pa.concat_arrays([plain.cast(pa.large_binary()), pa.array([w for x in odd for w in x], pa.large_binary())])
    # back to the order of the texts
    group = np.argsort(strange, kind="stable")
    starts = np.empty(len(texts), np.int64)
    starts[group] = np.cumsum(sizes[group]) - sizes[group]
    return every.take(pa.array(gathered(np.arange(len(every)), starts, sizes))), sizes


_BLANKS = np.isin(np.arange(256), [32, *range(9, 14)])


def word_array(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """byte_words() of each text, end to end, and their numbers."""
    each = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*each, b""]).translate(LOWER), np.uint8)
    blank = _BLANKS[data]
    start = ~blank
    start[1:] &= blank[:-1]
    ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) + 1)
    sizes = np.diff(np.append(0, np.append(0, np.cumsum(start))[ends]))
    solid = ~blank
    return sliced(data[solid].tobytes(), (np.cumsum(solid) - 1)[start]), sizes


def rows(batch, *names: str, step: int = 128):
    """The rows of an Arrow batch as tuples, a few at a time, so that no batch stands in memory twice."""
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        yield from zip(*(part.column(n).to_pylist() for n in names))


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces flat[starts[i]:starts[i] + lengths[i]], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((starts - ends + lengths).astype(kind), lengths) + np.arange(total, dtype=kind)]
