"""Vector best-fit packing of token sequences.

Pieces of one length are interchangeable, so packing is planned on the counts
per length (a table no longer than the capacity) and carried out by ranks:
each piece gets its number among those of its length and looks up the run of
bins that the plan gives to that number.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import columns_of, pre_tokens, rows, save

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"


@dataclass(frozen=True)
class Limits:
    """Capacities of a bin, and the weight of each in the choice of a bin.

    attention is the sum of squared lengths.  choose is "residual" (the least
    weighted norm of what stays free) or "dot" (the largest weighted product of
    what is free and what the piece needs).
    """

    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY**2
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    choose: str = "residual"


def plan(counts: dict[int, int], limits: Limits = Limits()) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first bin, pieces per bin, offset) that place counts[length] pieces of every length.

    Longest first; bins of equal content form one class with a multiplicity, so
    the work grows with the number of lengths, not of pieces.
    """
    caps = np.array([limits.tokens, limits.documents, limits.attention], np.float64)
    weights = np.array(limits.weights) / caps
    free = np.zeros((0, 3))
    classes: list[tuple[int, int]] = []  # first bin, number of bins
    runs, bins = [], 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.float64)
        if (need > caps).any():
            raise ValueError(f"a piece of {length} tokens exceeds a bin")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero((free >= need).all(1)) if len(free) else []
            if len(fits):
                if limits.choose == "dot":
                    worth = -((free[fits] * weights) * (need / caps)).sum(1)
                else:
                    worth = (((free[fits] - need) * weights) ** 2).sum(1)
                c = int(fits[np.argmin(worth)])
                first, number = classes[c]
                each = int(min((free[c] // need).min(), max(1, left // number)))
                used = min(number, left)
            else:
                each = int(min((caps // need).min(), left))
                first, number, c = bins, left // each, len(classes)
                bins += number
                classes.append((first, number))
                free = np.vstack([free, caps])
                used = number
            # the first `used` bins of the class take `each` pieces
            runs.append((length, rank, used * each, first, each, int(limits.tokens - free[c, 0])))
            rank, left = rank + used * each, left - used * each
            after = free[c] - need * each
            if used < number:
                classes[c] = (first + used, number - used)
                classes.append((first, used))
                free = np.vstack([free, after])
            else:
                free[c] = after
            full = free[:, 0] < 1
            if full.any():
                classes = [x for x, f in zip(classes, full) if not f]
                free = free[~full]
    return runs


#: Texts of more characters are encoded in slices.
SLICE = 1 << 18
#: A place between two pre-tokens, whatever stands around it: a space after a letter or digit.
_GAP = re.compile(r"(?<=[A-Za-z0-9])(?= )")
#: White space too long for the pattern's own library, which overflows its stack on some thousands of characters.
_BLANK = re.compile(r"\s{500}")


def slices(text: str) -> list[str]:
    """text in pieces whose encodings, end to end, are that of text; one piece where no gap is found."""
    out, a = [], 0
    while len(text) - a > SLICE and (gap := _GAP.search(text, a + SLICE)):
        out.append(text[a : gap.start()])
        a = gap.start()
    return [*out, text[a:]]


def file_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a byte-level tokenizers file as bytes, with their ids, which are in the order of the merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    bytes_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(map(bytes_of.__getitem__, w)): i for w, i in model["vocab"].items() if all(c in bytes_of for c in w)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merges]
    if order != sorted(order):
        raise ValueError("the ids are not in the order of the merges")
    return ranks


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that a tokenizers file adds to its vocabulary, which are cut out of a text before all else."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that look at what stands beside them are not supported")
    return {t["content"]: t["id"] for t in added}


def token_bytes(path: str):
    """A function from a text to its ids, by the tokenizers file, as little-endian 32-bit bytes; an added token's string is its id.

    The file's vocabulary runs in the faster of the two libraries; the tests hold its ids against the other's.
    """
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=file_ranks(path), special_tokens={})
    added = added_tokens(path)
    # of tokens that begin at one place the longest
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None

    def ordinary(text: str) -> bytes:
        if _BLANK.search(text):
            return b"".join(array("I", encoding._encode_single_piece(w)).tobytes() for w in pre_tokens(text))
        return b"".join(array("I", encoding.encode_ordinary(s)).tobytes() for s in slices(text))

    def encode(text: str) -> bytes:
        parts = cut.split(text) if cut else [text]
        if len(parts) == 1:
            return ordinary(text)
        return b"".join(array("I", [added[x]]).tobytes() if i % 2 else ordinary(x) for i, x in enumerate(parts))

    return encode


_ENCODERS: dict[str, object] = {}


def _pieces(path: str | None, capacity: int, end: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import public_tokenizers

        at = path or public_tokenizers.path(VOCABULARY)
        encode = _ENCODERS.get(at) or _ENCODERS.setdefault(at, token_bytes(at))
        tail = array("I", [end]).tobytes()
        for batch in batches:
            doc, piece, start, length, crc, kept = [], [], [], [], [], []
            for d, text in rows(batch, "doc_id", "text"):
                ids = encode(text or "") + tail
                n = len(ids) // 4
                # of a long document the first piece is the one that may be short
                a, b, i = 0, n % capacity or min(n, capacity), 0
                while a < n:
                    own = ids[4 * a : 4 * b]
                    doc.append(d), piece.append(i), start.append(a), length.append(b - a), crc.append(zlib.crc32(own)), kept.append(own if keep_ids else None)
                    a, b, i = b, b + capacity, i + 1
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return cut


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END, limits: Limits = Limits(), keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its ids and the end id; a null or empty text is the end id
    alone; the string of an added token is its id, as the library has it.  Only documents longer
    than limits.tokens are cut.  Repeated rows and null ids are packed like any other.  Other columns are not read.  An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    source = columns_of(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    made = source.mapInArrow(_pieces(path, limits.tokens, end, keep_ids), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    pieces = save(made.withColumn("uid", F.monotonically_increasing_id()))

    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most limits.tokens rows
    runs = plan(counts, limits)
    schema = "r_length long, r_rank long, r_pieces long, r_bin long, r_each long, r_offset long"
    # at most a few runs for each of at most limits.tokens lengths, whatever the input
    lookup = F.broadcast(spark.createDataFrame(runs, schema))

    # the number of a piece among those of its length: a running number within a bucket, the counts of the buckets
    # before it in its shelf, and those of the shelves before
    buckets = pieces.withColumn("bucket", F.shiftright("uid", 12))
    sizes = buckets.groupBy("length", "bucket").agg(F.count("*").alias("n")).withColumn("shelf", F.shiftright("bucket", 12))
    before = lambda *keys, by: F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shelves = sizes.groupBy("length", "shelf").agg(F.sum("n").alias("n")).select("length", "shelf", before("length", by="shelf").alias("ahead"))
    sizes = sizes.select("length", "shelf", "bucket", before("length", "shelf", by="bucket").alias("before")).join(shelves, ["length", "shelf"]).select("length", "bucket", (F.col("before") + F.col("ahead")).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("uid")) - 1
    ranked = buckets.withColumn("number", number).join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("number"))
    placed = ranked.join(lookup, (F.col("length") == F.col("r_length")) & (F.col("rank") >= F.col("r_rank")) & (F.col("rank") < F.col("r_rank") + F.col("r_pieces")))
    at = F.col("rank") - F.col("r_rank")
    out = placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("r_bin") + F.floor(at / F.col("r_each"))).cast("long").alias("sequence_id"),
        (F.col("r_offset") + (at % F.col("r_each")) * F.col("length")).cast("long").alias("offset"), "ids",
    )
    return out if keep_ids else out.drop("ids")
