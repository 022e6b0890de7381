"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A task reads documents in blocks and numbers the distinct pre-tokens of a
block; a document is then the list of these numbers, in order.  The blocks'
words are shuffled by word, so that each distinct word is encoded once, and the
ids go back to the blocks that hold it, where documents are put together again
by position.  Decoding joins the ids with the table of token bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, in_blocks, squeezed, unlisted, unsqueezed
from .common import columns_of, gathered, pre_token_array, rows

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Ids decoded at a time.
SLICE = 1 << 20


def read_ranks(path: str | None) -> dict[bytes, int]:
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _encode(path: str | None):
    """A bucket's messages (block, bucket, n, words) to replies (block, bucket, lengths, ids); a distinct word is encoded once."""

    def encoded(table: pa.Table) -> pa.Table:
        import public_tokenizers
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})

        class Known(dict):
            def __missing__(self, word: bytes) -> list[int]:
                value = self[word] = encoding._encode_single_piece(word)
                return value

        known, lengths, ids = Known(), [], []
        for blob in table["words"]:
            own = [known[w] for w in unlisted(blob.as_py())]
            lengths.append(squeezed(np.fromiter(map(len, own), np.uint32, len(own))))
            ids.append(squeezed(np.array([i for x in own for i in x], np.uint32)))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "lengths": pa.array(lengths, pa.binary()), "ids": pa.array(ids, pa.binary())})

    return encoded


def _assemble(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents, their numbers replaced by the ids of its words."""
    replies = sorted(right.to_pylist(), key=lambda r: r["bucket"])
    lengths = np.concatenate([np.zeros(0, np.int64)] + [unsqueezed(r["lengths"]).astype(np.int64) for r in replies])
    flat = np.concatenate([np.zeros(0, np.uint32)] + [unsqueezed(r["ids"]) for r in replies])
    docs, counts, out = [], [], []
    for row in left.to_pylist():
        if row["distinct"] != len(lengths):
            raise RuntimeError("the words of a block are incomplete")
        places = unsqueezed(row["places"])
        starts, sizes = (np.cumsum(lengths) - lengths)[places], lengths[places]
        numbers, a = unsqueezed(row["numbers"]), 0
        for doc_id, n in zip(row["doc_ids"], row["sizes"]):
            own = numbers[a : a + n]
            ids = gathered(flat, starts[own], sizes[own])
            docs.append(doc_id), counts.append(len(ids)), out.append(ids.astype("<u4").tobytes())
            a += n
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(out, pa.binary())})


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    A null or empty text has no tokens.  Repeated rows and null ids stay as they
    are.  docs must give the same rows in the same partitions each time it is
    read, as tables do; it is read twice, once for words and once for positions,
    and a difference fails the job.  Other columns are not read.
    """
    source = columns_of(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    words, placed, _ = in_blocks(source.withColumn("counted", F.lit(True)), pre_token_array, block_chars, once=False)
    ids = words.drop("counts").groupBy("bucket").applyInArrow(_encode(path), "block long, bucket int, lengths binary, ids binary")
    return placed.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_assemble, "doc_id long, n_tokens long, ids binary")


def _decode(path: str | None):
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[int, bytes] = {rank: token for token, rank in read_ranks(path).items()}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        flat, lengths = np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int32, len(tokens))
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        for batch in batches:
            ids = (np.frombuffer(x, "<u4") for (x,) in rows(batch, "ids"))
            data = [b"".join(gathered(flat, starts[i], lengths[i]).tobytes() for i in np.split(x, range(SLICE, len(x), SLICE))) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "bytes"])

    return decoded


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with a further column bytes: the bytes of its ids, by the token-byte table of the vocabulary (of fixed size)."""
    schema = encoded.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return encoded.mapInArrow(_decode(path), f"{schema},bytes:binary")


def bpe_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return decode(encode(docs, path=path), path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
