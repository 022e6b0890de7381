"""Exact deduplication by Golomb-coded fingerprint exchange.

Every sender (a partition of the digest table) sends each owner of a range of
fingerprints one sorted, Golomb-Rice coded list of the distinct fingerprints it
holds, and gets back a bitmap of those that some other sender holds as well.
Only the rows behind a set bit, and those repeated within a sender, are
suspects: their texts are shuffled and compared byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, columns_of, join_hot, numbered, only_ids, parallelism, save

#: Deleted before texts are compared.
SPACES = " \t\n\x0b\x0c\r"
#: A sender codes at most so many rows in one message, which bounds its memory.
MESSAGE_ROWS = 250_000
#: Rows for which one owner answers.
OWNER_ROWS = 500_000


def golomb_encode(values: np.ndarray, k: int) -> bytes:
    """Ascending distinct values as gaps: quotients by 2**k in unary, then k-bit remainders."""
    gaps = np.diff(values, prepend=np.uint64(0))
    quotients, ends = gaps >> np.uint64(k), None
    ends = np.cumsum(quotients + np.uint64(1)).astype(np.int64) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(blob: bytes, n: int, k: int) -> np.ndarray:
    """The n values that golomb_encode() was given."""
    data = np.frombuffer(blob, np.uint8)
    tail = (n * k + 7) // 8
    bits = np.unpackbits(data[: len(data) - tail])
    quotients = np.diff(np.flatnonzero(bits)[:n], prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = np.unpackbits(data[len(data) - tail :], count=n * k).reshape(n, k).astype(np.uint64)
    rest = (rest << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if k else np.zeros(n, np.uint64)
    return np.cumsum((quotients << np.uint64(k)) + rest, dtype=np.uint64)


def _rice_parameter(bits: int, owners: int, n: int) -> int:
    return max(0, int(math.log2(max(1.0, 2.0**bits / owners / max(1, n)))))


def _send(bits: int, owners: int):
    """Rows (uid, sha) of a partition to one coded message for each owner, with the row ids in the order of the code."""

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, rows, number = [], 0, TaskContext.get().partitionId() << 33

        def flush():
            uid = np.concatenate([a for a, _ in held])
            fp = np.concatenate([b for _, b in held])
            order = np.argsort(fp, kind="stable")
            uid, fp = uid[order], fp[order]
            width = (1 << bits) // owners + 1
            owner = (fp // np.uint64(width)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            out = []
            for a, b in zip(cuts, [*cuts[1:], len(fp)]):
                own = fp[a:b] - np.uint64(int(owner[a]) * width)
                new = np.diff(own, prepend=own[0] + np.uint64(1)) != 0
                distinct = own[new]
                k = _rice_parameter(bits, owners, len(distinct))
                out.append((number, int(owner[a]), len(distinct), k, golomb_encode(distinct, k), uid[a:b].tobytes(), np.packbits(new).tobytes()))
            names = ["sender", "owner", "n", "k", "code", "uids", "first"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])], names)

        for batch in batches:
            sha = b"".join(batch.column("sha").to_pylist())
            top = np.frombuffer(sha, ">u8").reshape(-1, 4)[:, 0].astype(np.uint64) >> np.uint64(64 - bits)
            held.append((batch.column("uid").to_numpy(zero_copy_only=False), top))
            rows += len(top)
            if rows >= MESSAGE_ROWS:
                yield flush()
                held, rows, number = [], 0, number + 1
        if rows:
            yield flush()

    return messages


def _answer(table: pa.Table) -> pa.Table:
    """For one owner: which of each message's fingerprints another message has too."""
    lists = [golomb_decode(c, n, k) for c, n, k in zip(table["code"].to_pylist(), table["n"].to_pylist(), table["k"].to_pylist())]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    found = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return pa.table({"sender": table["sender"], "owner": table["owner"], "dup": pa.array(found, pa.binary())})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, uids, first, dup in zip(*(batch.column(c).to_pylist() for c in ("n", "uids", "first", "dup"))):
            uid = np.frombuffer(uids, np.int64)
            at = np.cumsum(np.unpackbits(np.frombuffer(first, np.uint8), count=len(uid))) - 1
            again = np.bincount(at, minlength=n) > 1
            out.append(uid[(again | np.unpackbits(np.frombuffer(dup, np.uint8), count=n).astype(bool))[at]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))], ["uid"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting SPACES; of equal texts the row
    with the most code points in the original stays, then the smallest id.  A
    null text counts as empty.  A null id sorts after all others.  Of repeated
    rows with one id, one alone is kept.  An empty table gives an empty result.
    Other columns of docs are not read.  row_col is a column of distinct numbers
    by which the result tells rows apart, if given.
    """
    uid, keys = (F.col("uid"), ["uid"]) if row_col else (F.monotonically_increasing_id().alias("uid"), [])
    source = columns_of(docs, id_col, text_col, *([row_col] if row_col else [])).toDF("doc_id", "text", *keys).withColumn("text", F.coalesce("text", F.lit("")))
    normal = F.translate("text", SPACES, "")
    digests = save(source.select(uid, "doc_id", F.char_length("text").alias("length"), F.unhex(F.sha2(normal, 256)).alias("sha")))
    rows = digests.count()
    bits = min(62, max(32, math.ceil(math.log2(rows + 2)) + 14))
    owners = max(parallelism(docs.sparkSession), rows // OWNER_ROWS + 1)

    sent = save(digests.select("uid", "sha").mapInArrow(_send(bits, owners), "sender long, owner int, n int, k int, code binary, uids binary, first binary"))
    answers = sent.select("sender", "owner", "n", "k", "code").groupBy("owner").applyInArrow(_answer, "sender long, owner int, dup binary")
    suspects = sent.drop("code", "k").join(answers, ["sender", "owner"]).select("n", "uids", "first", "dup").mapInArrow(_suspects, "uid long")
    suspects = save(digests.join(suspects, "uid"))

    # bytes decide: a group is the normalised text itself, of which each task sends one copy
    texts = only_ids(source, suspects, "doc_id").select(F.sha2(normal, 256).alias("text_sha256"), normal.alias("text")).distinct()
    proven = texts.groupBy("text_sha256").agg(F.count("*").alias("texts"))
    proven = proven.select("text_sha256", F.when(F.col("texts") > 1, F.raise_error(F.lit("different texts with one SHA-256"))).otherwise(F.lit(True)).alias("same")).where("same is null or same")
    groups = suspects.groupBy("sha").agg(F.count("*").alias("group_size"), F.max(F.struct("length", F.coalesce(-F.col("doc_id"), F.lit(-(2**63))).alias("back"), (-F.col("uid")).alias("row"), "doc_id")).alias("best"))
    groups = save(groups.withColumn("text_sha256", F.lower(F.hex("sha"))).join(proven, "text_sha256").select("sha", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.row")).alias("keep_uid")))
    decided = join_hot(suspects, groups, "sha", "group_size").select("uid", "group_size", "keep_id", (F.col("uid") == F.col("keep_uid")).alias("kept"))
    return digests.join(decided, "uid", "left").select(
        *([F.col("uid").alias(row_col)] if row_col else []),
        "doc_id",
        F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup() keeps, all columns.

    Rows are told apart by a number of their own: of repeated rows one stays,
    null ids or not.  Of texts that are null, empty or blank one stays.
    """
    table = numbered(docs)
    gone = exact_dedup(table, row_col=ROW).where("not kept").select(ROW)
    return table.join(gone, ROW, "left_anti").select(*docs.columns)
