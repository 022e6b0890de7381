"""Documents in blocks: word numbers by position, and each block's distinct words as messages by hash bucket.

A block bounds what a task holds.  Its documents are lists of word numbers; its
distinct words are sent once, sorted and compressed, to the bucket that answers
for them, and the answers come back to the block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, rows, save

#: Characters after which a block ends.
BLOCK_CHARS = 8_000_000
#: Characters after which texts are cut into words, as this takes many bytes a character.
CUT_CHARS = 1_000_000
#: Bytes of text for which there is one bucket; a bucket's task holds their distinct words.
BUCKET_BYTES = 256 << 20
WORDS = "block long, bucket int, n int, words binary, counts binary"
PLACES = "block long, doc_ids array<long>, sizes array<long>, counted array<boolean>, distinct long, numbers binary, places binary"
#: Both kinds of rows in one table.
BOTH = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("counted", pa.list_(pa.bool_())), ("distinct", pa.int64()), ("numbers", pa.binary()), ("places", pa.binary())])


def squeezed(numbers: np.ndarray) -> bytes:
    """Low and high halves apart, as the high ones are mostly zero."""
    import zstandard

    n = numbers.astype("<u4").view("<u2").reshape(-1, 2)
    return zstandard.compress(np.ascontiguousarray(n.T).tobytes(), 3)


def unsqueezed(blob: bytes) -> np.ndarray:
    import zstandard

    n = np.frombuffer(zstandard.decompress(blob), "<u2").reshape(2, -1).astype(np.uint32)
    return n[0] | (n[1] << np.uint32(16))


def listed(lengths: np.ndarray, text: bytes) -> bytes:
    """Words as their number, their lengths and their text."""
    import zstandard

    return zstandard.compress(np.append(len(lengths), lengths).astype("<u4").tobytes() + text, 3)


def unlisted(blob: bytes) -> list[bytes]:
    import zstandard

    data = zstandard.decompress(blob)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 * n + 4).tolist()
    return [data[a:b] for a, b in zip([4 * n + 4, *ends], ends)]


class Block:
    """Documents, and in the end their words as numbers; tokens gives all words of a list of texts, and the number of each text's."""

    def __init__(self, tokens: Callable[[list[str]], tuple[pa.Array, np.ndarray]]):
        self.tokens = tokens
        self.texts, self.ids, self.counted, self.chars, self.uncut = [], [], [], 0, 0
        self.found, self.sizes = [], []

    def add(self, doc_id, text: str | None, counted: bool = True) -> None:
        self.texts.append(text or ""), self.ids.append(doc_id), self.counted.append(counted)
        self.chars += len(self.texts[-1]) + 1
        self.uncut += len(self.texts[-1]) + 1
        if self.uncut >= CUT_CHARS:
            self.cut()

    def cut(self) -> None:
        """The texts so far become words."""
        found, sizes = self.tokens(self.texts)
        self.found.append(found.cast(pa.large_binary())), self.sizes.append(sizes)
        self.texts, self.uncut = [], 0

    def numbers(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """All documents' numbers, the words that they stand for, and each document's number of words; frequent words come first, which compresses well."""
        self.cut()
        coded, sizes = pa.concat_arrays(self.found).dictionary_encode(), np.concatenate(self.sizes)
        self.found = []
        at = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(-np.bincount(at, minlength=len(coded.dictionary)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        return place[at], coded.dictionary.take(pa.array(order)), sizes

    def messages(self, at: np.ndarray, words: pa.Array, sizes: np.ndarray, buckets: int) -> tuple[list[tuple[int, int, bytes, bytes]], np.ndarray]:
        """By hash bucket the number of words, the words, sorted, and their counts in the counted documents; and for each number its place in the messages put one after the other."""
        import xxhash

        by = pc.sort_indices(words).to_numpy().astype(np.int64)
        words = words.take(pa.array(by))
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False).tolist()), np.uint64, len(words)) % np.uint64(buckets)
        again = np.argsort(hashed, kind="stable")
        by, hashed, words = by[again], hashed[again], words.take(pa.array(again)).cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
        text = memoryview(words.buffers()[2]) if len(words) and words.buffers()[2] else memoryview(b"")
        place = np.empty(len(by), np.uint32)
        place[by] = np.arange(len(by), dtype=np.uint32)
        counts = np.bincount(at[np.repeat(self.counted, sizes)] if len(at) else at, minlength=len(by))[by]
        bounds = np.searchsorted(hashed, np.arange(buckets + 1, dtype=np.uint64)).tolist()
        return [(b, y - x, listed(np.diff(offsets[x : y + 1]), text[offsets[x] : offsets[y]].tobytes()), squeezed(counts[x:y])) for b, (x, y) in enumerate(zip(bounds, bounds[1:])) if y > x], place


def _made(tokens: Callable[[list[str]], tuple[pa.Array, np.ndarray]], chars: int, buckets: int, words: bool, places: bool):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), 0

        def flush(block: Block) -> Iterator[pa.RecordBatch]:
            at, known, sizes = block.numbers()
            # blocks that were cut differently have different names, and so are never joined
            name = xxhash.xxh3_64_intdigest(at.tobytes() + repr((part, serial, block.ids)).encode()) >> 1
            sent, place = block.messages(at, known, sizes, buckets)
            if words:
                bucket, n, text, counts = zip(*sent) if sent else ((), (), (), ())
                yield pa.RecordBatch.from_pydict({"block": pa.array([name] * len(sent), pa.int64()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(n, pa.int32()), "words": pa.array(text, pa.binary()), "counts": pa.array(counts, pa.binary())})
            if places:
                yield pa.RecordBatch.from_pydict({"block": pa.array([name]), "doc_ids": pa.array([block.ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())), "counted": pa.array([block.counted], pa.list_(pa.bool_())), "distinct": pa.array([len(place)], pa.int64()), "numbers": pa.array([squeezed(at)], pa.binary()), "places": pa.array([squeezed(place)], pa.binary())})

        def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
            if not (words and places):
                return batch
            return pa.RecordBatch.from_arrays([batch.column(f.name) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in BOTH], schema=BOTH)

        block = Block(tokens)
        for batch in batches:
            for doc_id, text, counted in rows(batch, "doc_id", "text", "counted"):
                block.add(doc_id, text, counted)
                if block.chars >= chars:
                    yield from map(whole, flush(block))
                    block, serial = Block(tokens), serial + 1
        if block.ids:
            yield from map(whole, flush(block))

    return made


def text_bytes(source: DataFrame) -> int:
    """Bytes of all texts, which tell how many buckets keep a bucket's words within a task."""
    return source.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def in_blocks(source: DataFrame, tokens: Callable[[list[str]], tuple[pa.Array, np.ndarray]], chars: int = BLOCK_CHARS, once: bool = True) -> tuple[DataFrame, DataFrame, int]:
    """Of source (doc_id, text, counted): the blocks' messages (WORDS), the blocks' documents (PLACES), and the number of buckets.

    The buckets grow with the bytes of text.  With once, texts are tokenised
    once, into one saved table; without, they are tokenised for either result,
    which takes less disk, and source must give the same rows in the same
    partitions each time, as tables do.
    """
    source = source.select("doc_id", "text", "counted")
    buckets = max(parallelism(source.sparkSession), -(-text_bytes(source) // BUCKET_BYTES))
    if not once:
        return source.mapInArrow(_made(tokens, chars, buckets, True, False), WORDS), source.mapInArrow(_made(tokens, chars, buckets, False, True), PLACES), buckets
    both = save(source.mapInArrow(_made(tokens, chars, buckets, True, True), f"{WORDS}, {PLACES.split(', ', 1)[1]}"))
    return both.where("words is not null").select("block", "bucket", "n", "words", "counts"), both.where("numbers is not null").select("block", "doc_ids", "sizes", "counted", "distinct", "numbers", "places"), buckets
