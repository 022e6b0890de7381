"""Near-duplicate detection: MinHash signatures joined by a multi-index Hamming join.

A signature has CHUNKS x WIDTH values of 16 bits.  Two signatures that differ in
fewer than CHUNKS * (ERRORS + 1) values agree, by the pigeonhole principle, on
all but ERRORS values of some chunk.  Every chunk is therefore indexed once for
each choice of ERRORS values left out, so each such pair shares a key.  Pairs
that share a key and whose signatures are near are confirmed on the full
shingle sets.

Documents with the same shingle set are one class from the start.  A key that
few classes share gives all its pairs.  A key that many share gives pairs with
a few hubs only, after which the classes already connected need no more pairs;
what a key still leaves in several components is compared in blocks, exactly,
and only pairs that connect components leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, WordHashes, byte_words, columns_of, components, drop_saved, join_hot, mix, numbered, only_ids, rows, save

SHINGLE = 5
CHUNKS, WIDTH = 15, 5
VALUES = CHUNKS * WIDTH
#: Signatures further apart are not confirmed; at a similarity of 0.75 a distance over 40 of 75 has a chance below 1 in 10 millions.
NEAR = 40
#: Least similarity, as a fraction of integers.
SIMILAR = (75, 100)
#: A key of more classes goes by hubs.
SMALL = 12
HUBS = 2
#: Classes in a block of a large key.
BLOCK = 256

_SEEDS = np.random.default_rng(20240501).integers(1, 2**63, (2, VALUES), dtype=np.uint64) | np.uint64(1)
_WORD_SEEDS = np.random.default_rng(77).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, none without words."""
    words = byte_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, len(words) if len(words) < SHINGLE else 0, np.uint64)
    for j in range(min(SHINGLE, len(h))):
        out += h[j : n + j] * _WORD_SEEDS[j]
    return np.unique(mix(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the least value of each of the hash functions."""
    least = np.full(VALUES, 2**64 - 1, np.uint64)
    for a in range(0, len(shingles), 256):
        np.minimum(least, (shingles[a : a + 256, None] * _SEEDS[0] + _SEEDS[1]).min(0), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


_KNOWN = WordHashes()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        ids, sizes, sets, signed = [], [], [], []
        for doc_id, text in rows(batch, "doc_id", "text"):
            s = shingle_hashes(text, _KNOWN)
            ids.append(doc_id), sizes.append(len(s))
            sets.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signed.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "set_hash", "signature"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A class to its keys: one for each chunk and left-out value."""
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            part = batch.slice(a, 2000)
            sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            place = np.arange(VALUES, dtype=np.uint64).reshape(CHUNKS, WIDTH)
            each = mix(sig + (place << np.uint64(20)) + np.uint64(1))
            keys = mix(each.sum(2, dtype=np.uint64)[:, :, None] - each + (place << np.uint64(40)))
            ids = np.repeat(part.column("node").to_numpy(), VALUES)
            # the low four bits of a key name its chunk
            keys = (keys & ~np.uint64(15)) | (place // np.uint64(WIDTH))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "node"])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, VALUES) for c in ("sig_u", "sig_v"))
        n, m = batch.column("n_u").to_numpy(), batch.column("n_v").to_numpy()
        good = ((a != b).sum(1) <= NEAR) & (SIMILAR[1] * np.minimum(n, m) >= SIMILAR[0] * np.maximum(n, m))
        yield batch.select(["u", "v"]).filter(pa.array(good))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            sets = [shingle_hashes(t, _KNOWN).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in rows(batch, "set_u", "set_v"):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            good.append(SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both))
        yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a key's members against blocks of its unconnected ones: similar pairs in different components.

    Of the keys that a pair shares, only the one of the first chunk on which it
    agrees looks at the pair.  The sets at hand hold the low half of each
    shingle's hash, so the pairs are confirmed on the whole hashes later.  One
    partner in each other component, the most similar, connects a member.
    """
    for batch in batches:
        for row in batch.to_pylist():
            a, b = (np.frombuffer(b"".join(m["signature"] for m in row[c]), np.uint16).reshape(-1, VALUES) for c in ("few", "many"))
            id_a, id_b = (np.array([m["node"] for m in row[c]], np.int64) for c in ("few", "many"))
            in_a, in_b = (np.array([m["component"] for m in row[c]], np.int64) for c in ("few", "many"))
            set_a, set_b = ([np.frombuffer(m["halves"], np.uint32) for m in row[c]] for c in ("few", "many"))
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(len(a)):
                unlike = b != a[i]
                at = np.flatnonzero((unlike.sum(1) <= NEAR) & (in_b != in_a[i]))
                at = at[(unlike[at].reshape(-1, CHUNKS, WIDTH).sum(2) <= 1).argmax(1) == row["chunk"]]
                if not len(at):
                    continue
                own, sizes = set_a[i], np.array([len(set_b[j]) for j in at])
                flat = np.concatenate([set_b[j] for j in at])
                hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                # two hashes with one half each make the union smaller by one, and the pair may seem less similar by that
                good = SIMILAR[1] * (both + 1) >= SIMILAR[0] * (len(own) + sizes - both - 1)
                at = at[good][np.argsort(-(both / (len(own) + sizes - both))[good], kind="stable")]
                at = at[np.unique(in_b[at], return_index=True)[1]]
                u.append(np.maximum(id_b[at], id_a[i])), v.append(np.minimum(id_b[at], id_a[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            sets = [np.unique(shingle_hashes(t, _KNOWN).astype(np.uint32)).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "halves"])


def _links(pairs: DataFrame, classes: DataFrame, source: DataFrame) -> DataFrame:
    """Of distinct pairs (u, v) of classes those whose full shingle sets are similar."""
    of = lambda side: classes.select(F.col("node").alias(side), F.col("signature").alias(f"sig_{side}"), F.col("n_shingles").alias(f"n_{side}"))
    near = save(pairs.distinct().join(of("u"), "u").join(of("v"), "v").mapInArrow(_distances, "u long, v long"))
    nodes = near.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = save(only_ids(source, nodes, "node").mapInArrow(_shingles, "node long, shingles binary"))
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    links = save(near.join(side("u"), "u").join(side("v"), "v").select("u", "v", "set_u", "set_v").mapInArrow(_confirm, "u long, v long"))
    drop_saved(sets), drop_saved(near)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= 75 * union of their sets of
    five-word shingles; component_id is the smallest doc_id reachable.  A null,
    empty or blank text has no shingles and is linked with nothing.  Rows that
    repeat a doc_id count as one document: the texts of one id are told apart
    by nothing, so ids should be unique; a null id is a component of its own.
    An empty table gives an empty result.  Other columns are not read.
    """
    source = columns_of(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = save(source.mapInArrow(_sign, "doc_id long, n_shingles long, set_hash binary, signature binary"))
    known_row = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    known = signed.where(known_row)
    classes = save(known.groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("copies")))
    texts = source.withColumnRenamed("doc_id", "node")

    keys = save(classes.select("node", "signature").mapInArrow(_index, "key long, node long"))
    hubs = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), F.col("node").alias("node"))).alias(f"hub{i}") for i in range(HUBS)]
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = save(keys.join(shared, "key"))
    drop_saved(keys)

    small = members.where(F.col("n") <= SMALL).select("key", "node")
    pairs = small.alias("a").join(small.alias("b"), "key").where("a.node > b.node").select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
    large = members.where(F.col("n") > SMALL).select("key", "node")
    centres = save(large.groupBy("key").agg(*hubs).select("key", F.array_distinct(F.array(*[f"hub{i}.node" for i in range(HUBS)])).alias("hubs")))
    # one row a membership; what many keys of a node have in common is merged before it is exploded
    held = large.join(centres, "key").select("node", "hubs").distinct()
    starred = held.select("node", F.explode("hubs").alias("hub")).where("node <> hub").select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v"))
    links = _links(pairs.unionByName(starred), classes, texts)
    found = components(links)

    # what a large key still leaves apart
    state = large.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    sizes = state.groupBy("key", "component").agg(F.count("*").alias("size"))
    used = [members, centres]
    main = save(sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts"), F.sum("size").alias("n")).where("parts > 1").select("key", F.col("top.component").alias("main"), "n"))
    if not main.isEmpty():
        open_keys = save(state.join(main, "key"))
        halves = only_ids(texts, open_keys, "node").mapInArrow(_halves, "node long, halves binary")
        known_sets = save(halves.join(classes.select("node", "signature"), "node"))
        open_keys = open_keys.join(known_sets, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.floor(F.col("n") / BLOCK) + 1))
        member = F.collect_list(F.struct("node", "component", "signature", "halves"))
        many = open_keys.groupBy("key", "block").agg(member.alias("many")).select("key", "many")
        few = open_keys.where("component <> main").groupBy("key", "block").agg(member.alias("few")).select("key", "few")
        rest = few.join(many, "key").select("few", "many", F.col("key").bitwiseAND(15).alias("chunk")).mapInArrow(_compare_blocks, "u long, v long")
        found = components(links.unionByName(_links(rest, classes, texts)))
        used += [known_sets]

    for table in used:
        drop_saved(table)

    home = save(classes.select("set_hash", "node", "copies").join(found, "node", "left").select("set_hash", "copies", F.coalesce("component", "node").alias("component")))
    linked = join_hot(signed.where(known_row), home, "set_hash", "copies").select("doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("component") == F.col("doc_id")).alias("kept"))
    alone = signed.where(~known_row).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Of each component of near copies among the rows of docs the row with the smallest id (null last), all columns.

    Rows are told apart by a number of their own, so repeated and null ids are
    no copies by that.  Rows without words are linked with nothing and stay.
    """
    table = numbered(docs)
    found = near_duplicates(table, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id").join(table.select(ROW, "doc_id"), ROW)
    best = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", ROW)).alias("best"))
    return table.join(best.select(f"best.{ROW}"), ROW, "left_semi").select(*docs.columns)
