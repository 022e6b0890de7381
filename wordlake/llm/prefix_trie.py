"""Prefix trie of conversations: which turns many conversations start with, and what sharing them saves.

Turns (role, text) become numbers by a dictionary in the order of role and text.
Equal conversations are one row with their number, and ranges of these rows in
the order of their numbers are shards.  A shard is a ternary search tree, to
which rows are added by medians, so that the branches of a node stay balanced;
an iterative pass from the last node to the first accumulates members, leaves
and savings.  Only the nodes on the way to a shard's first and last row may have
more rows in other shards: these boundary nodes are merged, a few shards at a
time, until one range is left.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, join_hot, parallelism, save

#: Families of ids whose conversations may share the first one's start, and how many turns at most.
FAMILY, SHARED = 20, 3
#: Turns of a shard; a partition holds one shard at a time.
SHARD_TURNS = 500_000
#: Leading turns by which ranges are cut; rows that share them all stay in one range.
RANGE_TURNS = 32
#: Shards whose boundary nodes are merged at a time.
FAN_IN = 16
#: Ids of a conversation's copies in one row on their way to its digest.
CHUNK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, key): rows with an id; null roles and texts are empty; equal (role, text) have equal keys."""
    source = columns_of(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    source = source.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role"), empty("text"))
    return source.withColumn("key", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def turn_dictionary(turns: DataFrame) -> DataFrame:
    """(turn_id, role, text, key, words, n), saved: distinct turns, numbered in the order of role and text; words in the text, and how often the turn occurs."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    distinct = turns.groupBy("role", "text", "key").agg(F.count("*").alias("n"))
    parts = parallelism(turns.sparkSession)
    ordered = distinct.repartitionByRange(parts, "role", F.substring("text", 1, 64)).sortWithinPartitions("role", "text")
    return save(ordered.select(F.monotonically_increasing_id().alias("turn_id"), "role", "text", "key", words.alias("words"), "n"))


def encoded(turns: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(conv_id, ids, words), saved: conversations as turn numbers in the order of turn (null first) and, where it is repeated, of role and text."""
    known = dictionary.select("key", "turn_id", "words", "n")
    found = join_hot(turns.select("conv_id", "turn", "key"), known, "key", "n").select("conv_id", F.struct("turn", "turn_id", "words").alias("t"))
    found = found.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return save(found.select("conv_id", F.col("t.turn_id").alias("ids"), F.col("t.words").alias("words")))


def rebuilt(convs: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Conversations whose first h turns, h = crc32(id) % (shared + 1), are those of the first of their family."""
    head = F.col("conv_id") - F.col("conv_id") % family
    first = convs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("head"), F.slice("ids", 1, shared).alias("head_ids"), F.slice("words", 1, shared).alias("head_words"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (shared + 1)).cast("int")
    both = convs.withColumn("head", head).withColumn("h", h).join(first, "head", "left")
    start = lambda c: F.slice(F.coalesce(F.col(f"head_{c}"), F.array().cast("array<long>")), F.lit(1), F.col("h"))
    rest = lambda c: F.slice(F.col(c), F.col("h") + 1, F.greatest(F.lit(0), F.size(c) - F.col("h")))
    return both.select("conv_id", F.concat(start("ids"), rest("ids")).alias("ids"), F.concat(start("words"), rest("words")).alias("words"))


_CHUNKS = pa.schema([("skey", pa.binary()), ("first", pa.int64()), ("members", pa.binary()), ("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (skey, conv_id, ids, words), sorted, to chunks of members; ids are kept as differences."""
    import zstandard

    held: list[int] = []
    now = None

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            blob = zstandard.compress(np.diff(np.array(held, np.int64)).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((now[0], held[0], blob, *now[1:]), _CHUNKS)], schema=_CHUNKS)
            held.clear()

    for batch in batches:
        keys, members = batch.column("skey").to_pylist(), batch.column("conv_id").to_pylist()
        for i, (key, member) in enumerate(zip(keys, members)):
            if now is None or key != now[0] or len(held) >= CHUNK:
                yield from flush()
                now = (key, batch.column("ids")[i].as_py(), batch.column("words")[i].as_py())
            held.append(member)
    yield from flush()


_SEQUENCES = pa.schema([("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks, sorted by (skey, first), to one row per conversation text with the digest of its members; a chunk is in memory at a time."""
    import zstandard

    now, out = None, []

    def done() -> list:
        key, ids, words, n, least, digest = now
        return [ids, words, n, least, digest.hexdigest()]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEQUENCES)], schema=_SEQUENCES)

    for batch in batches:
        for i in range(batch.num_rows):
            key, first, blob = (batch.column(c)[i].as_py() for c in ("skey", "first", "members"))
            members = first + np.append(0, np.cumsum(np.frombuffer(zstandard.decompress(blob), np.int64)))
            text = ",".join(map(str, members.tolist())).encode()
            if now is None or now[0] != key:
                if now is not None:
                    out.append(done())
                now = [key, batch.column("ids")[i].as_py(), batch.column("words")[i].as_py(), 0, first, hashlib.sha256()]
            else:
                now[5].update(b",")
            now[3] += len(members)
            now[5].update(text)
        if out:
            yield batch_of(out)
            out = []
    if now is not None:
        yield batch_of([done()])


def sequences(convs: DataFrame) -> DataFrame:
    """(ids, words, n, least, ends): distinct conversations with their number, least id, and digest of their ids in order.

    Copies are cut into chunks over all partitions before the chunks of one
    conversation meet, so a conversation with very many copies costs one task
    only its compressed ids, in a stream.
    """
    spark = convs.sparkSession
    keyed = convs.withColumn("skey", F.unhex(F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)))
    parts = parallelism(spark)
    chunks = keyed.select("skey", "conv_id", "ids", "words").repartitionByRange(parts, "skey", "conv_id").sortWithinPartitions("skey", "conv_id").mapInArrow(_chunked, "skey binary, first long, members binary, ids array<long>, words array<long>")
    return chunks.repartition(parts, "skey").sortWithinPartitions("skey", "first").mapInArrow(_digested, "ids array<long>, words array<long>, n long, least long, ends string")


class Node(NamedTuple):
    """A node's row.  While it is on a boundary, shard is its range, first and last tell on which side, and the sums lack its children on the boundary."""

    turn_id: int | None
    depth: int
    conv_id: int
    parent_conv_id: int | None
    key: bytes | None
    parent_key: bytes | None
    n_convs: int
    n_children: int
    n_leaves: int
    saved: int
    words: int
    ends: str | None
    shard: int | None
    first: bool
    last: bool


_NODES = pa.schema([("turn_id", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("words", pa.int64()), ("ends", pa.string()), ("shard", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())])
NODES = "turn_id long, depth long, conv_id long, parent_conv_id long, key binary, parent_key binary, n_convs long, n_children long, n_leaves long, saved long, words long, ends string, shard long, first boolean, last boolean"


class Shard:
    """A ternary search tree of turn numbers; the branches of a node are its children's search tree, whose root is `down`."""

    def __init__(self) -> None:
        self.turn, self.less, self.more, self.down, self.parent, self.depth, self.n, self.least, self.words = (array("q") for _ in range(9))
        self.ends: dict[int, str] = {}
        self._add(-1, -1, 0, 0)

    def _add(self, turn: int, parent: int, depth: int, words: int) -> int:
        for a, value in ((self.turn, turn), (self.less, -1), (self.more, -1), (self.down, -1), (self.parent, parent), (self.depth, depth), (self.n, 0), (self.least, (1 << 63) - 1), (self.words, words)):
            a.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list[int], words: list[int], n: int, least: int, ends: str) -> None:
        turn, less, more, down = self.turn, self.less, self.more, self.down
        node = 0
        for depth, key in enumerate(ids):
            branches, at = down, node
            child = down[node]
            while child >= 0 and turn[child] != key:
                branches, at = (less if key < turn[child] else more), child
                child = branches[child]
            if child < 0:
                child = self._add(key, node, depth + 1, words[depth])
                branches[at] = child
            node = child
        self.n[node], self.least[node], self.ends[node] = n, least, ends

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a row that is in the tree, from the root."""
        out = [0]
        for key in ids:
            child = self.down[out[-1]]
            while self.turn[child] != key:
                child = self.less[child] if key < self.turn[child] else self.more[child]
            out.append(child)
        return out

    @classmethod
    def of(cls, rows: list[tuple]) -> Shard:
        """The tree of sorted rows (ids, words, n, least, ends), the median of every range first."""
        made, ranges = cls(), [(0, len(rows))]
        while ranges:
            a, b = ranges.pop()
            if a < b:
                m = (a + b) // 2
                made.insert(*rows[m])
                ranges += [(m + 1, b), (a, m)]
        return made

    def nodes(self, rows: list[tuple], shard: int) -> tuple[list[Node], list[Node]]:
        """Rows of the nodes that are whole here, and of those on the boundary."""
        firsts, lasts = self.path(rows[0][0]), self.path(rows[-1][0])
        keys: dict[int, bytes] = {}
        for way in (firsts, lasts):
            for parent, node in zip([-1, *way], way):
                keys[node] = node_key(keys.get(parent), self.turn[node])
        size = len(self.turn)
        children, leaves, saved = (array("q", bytes(8 * size)) for _ in range(3))
        for i in range(size - 1, -1, -1):  # children were added after their parents
            up = self.parent[i]
            if i not in keys:
                if not children[i]:
                    leaves[i] = 1
                saved[i] += (self.n[i] - 1) * self.words[i]
                children[up] += 1
                leaves[up] += leaves[i]
                saved[up] += saved[i]
            if up >= 0:
                self.n[up] += self.n[i]
                self.least[up] = min(self.least[up], self.least[i])
        on_first, on_last = set(firsts), set(lasts)
        whole, edge = [], []
        for i in range(size):
            up = self.parent[i]
            own = (self.turn[i] if i else None, self.depth[i], self.least[i])
            sums = (self.n[i], children[i], leaves[i], saved[i], self.words[i])
            if i in keys:
                edge.append(Node(*own, None, keys[i], keys.get(up), *sums, self.ends.get(i), shard, i in on_first, i in on_last))
            else:
                whole.append(Node(*own, None if up in keys else self.least[up], None, keys.get(up), *sums, self.ends.get(i), None, False, False))
        return whole, edge


def node_key(parent: bytes | None, turn: int) -> bytes:
    """A boundary node's name, the same in all shards."""
    return hashlib.sha256((parent or b"") + turn.to_bytes(8, "little", signed=True)).digest()


def merged(edges: list[Node], shard: int, final: bool) -> tuple[list[Node], list[Node]]:
    """Boundary nodes of neighbouring ranges to the nodes that are whole in their union, and those on its boundary (none if final)."""
    low, high = min(e.shard for e in edges), max(e.shard for e in edges)
    by: dict[bytes, list] = {}
    for e in edges:
        first, last = e.first and e.shard == low, e.last and e.shard == high
        if e.key not in by:
            by[e.key] = list(e._replace(shard=shard, first=first, last=last))
            continue
        x = by[e.key]
        for at, value in ((6, e.n_convs), (7, e.n_children), (8, e.n_leaves), (9, e.saved)):
            x[at] += value
        x[2], x[11] = min(x[2], e.conv_id), x[11] or e.ends
        x[13], x[14] = x[13] or first, x[14] or last
    whole, edge = [], []
    for x in sorted(by.values(), key=lambda x: -x[1]):
        if (x[13] or x[14]) and not final:
            edge.append(Node(*x))
            continue
        x[8] = x[8] if x[7] else 1
        x[9] += (x[6] - 1) * x[10]
        x[12], x[13], x[14] = None, False, False
        whole.append(Node(*x))
        if x[5] is not None:
            up = by[x[5]]
            up[7] += 1
            up[8] += x[8]
            up[9] += x[9]
    return whole, edge


def _table(nodes: list[Node]) -> pa.RecordBatch:
    columns = list(zip(*nodes)) if nodes else [()] * len(_NODES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODES)], schema=_NODES)


def _shards(turns: int):
    """Sorted rows of a range to nodes; a range of more turns is cut into trees, one at a time, whose boundaries are merged on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, size, edge = TaskContext.get().partitionId(), [], 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal edge
            whole, new = Shard.of(held).nodes(held, 1)
            yield _table(whole)
            if edge:
                whole, new = merged([*(e._replace(shard=0) for e in edge), *new], 1, False)
                yield _table(whole)
            edge = new

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("ids", "words", "n", "least", "ends"))):
                held.append(row)
                size += len(row[0]) + 1
                if size >= turns:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()
        if edge:
            yield _table([e._replace(shard=part) for e in edge])

    return run


def _merge(final: bool):
    def run(table: pa.Table) -> pa.Table:
        edges = [Node(*row) for row in zip(*(table.column(f.name).to_pylist() for f in _NODES))]
        whole, edge = merged(edges, edges[0].shard // FAN_IN, final)
        return pa.Table.from_batches([_table(whole + edge)])

    return run


def prefix_nodes(distinct: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie's nodes, one row each, of sequences(): turn_id, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = distinct.sparkSession
    distinct = save(distinct)
    turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    parts = max(parallelism(spark), -(-turns // shard_turns))
    ranged = distinct.repartitionByRange(parts, F.slice("ids", 1, RANGE_TURNS)).sortWithinPartitions("ids")
    made = [save(ranged.mapInArrow(_shards(shard_turns), NODES))]
    left = (made[0].agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        left = -(-left // FAN_IN)
        edges = made[-1].where("shard is not null")
        made.append(save(edges.groupBy(F.floor(F.col("shard") / FAN_IN).alias("__range")).applyInArrow(_merge(left <= 1), NODES)))
        if left <= 1:
            break
    nodes = made[0].where("shard is null")
    for more in made[1:]:
        nodes = nodes.unionByName(more.where("shard is null"))
    columns = ["turn_id", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    known = nodes.where("parent_key is null").select(*columns)
    waiting = nodes.where("parent_key is not null").select("parent_key", *[c for c in columns if c != "parent_conv_id"])
    parents = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__n"))
    nodes = known.unionByName(join_hot(waiting, parents, "parent_key", "__n").select(*columns))
    return nodes.select("turn_id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """The nodes of rebuilt conversations, and the dictionary of their turns, whose turn_id the nodes carry (the root's is null).

    Rows without a conv_id take no part.  Turns go by turn, null first, and
    equal ones by role and text; repeated rows are further turns.  Null roles and
    texts are empty; texts are read whole.  Families of negative ids go by the
    remainder of division towards zero.  A conversation's turn numbers are held
    whole by a task, its texts are not.  Other columns are not read.  Without
    conversations there is no node, not even a root.  Runs jobs when called.
    """
    turns = turn_rows(conversations)
    dictionary = turn_dictionary(turns)
    convs = encoded(turns, dictionary)
    return prefix_nodes(sequences(rebuilt(convs, family, shared))), dictionary
