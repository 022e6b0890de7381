"""Verified, partitioned output: a table is written beside its place, read back and compared, and only then published."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import hadoop_path, pointed, publish


class UnverifiedError(Exception):
    """Output that differs from its table, or is too small to replace what is there."""


def part_sums(table: DataFrame, part: str) -> DataFrame:
    """(part, rows, digest): of each part the number of rows and a digest of them that does not depend on their order."""
    values = [F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in sorted(c for c in table.columns if c != part)]
    row = F.sha2(F.concat_ws("\u0001", *values), 256)
    # four sums of 48 bits each of the row's hash, as whole numbers
    words = [F.conv(F.substring(row, 1 + 12 * i, 12), 16, 10).cast("long") for i in range(4)]
    hashed = table.select(F.col(part).cast("string").alias("part"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
    digest = F.sha2(F.concat_ws(",", *[F.sum(F.col(f"w{i}").cast("decimal(38,0)")).cast("string") for i in range(4)]), 256)
    return hashed.groupBy("part").agg(F.count("*").alias("rows"), digest.alias("digest"))


def write_parts(table: DataFrame, path: str, part: str, order: list[str], least: float = 0.5, kind: str = "parquet") -> DataFrame:
    """Writes table to one folder a part, sorted by order within, and gives the manifest (part, rows, digest), which stands beside it.

    Rows are dealt by ranges of part and order, so a large part is many files and
    no task's.  The files are read back, and the parts' counts and digests must be
    those of the table, both ways; no rows, or fewer than the share `least` of
    what is published, are refused.  A refused draft is removed and what was
    published stays.  Publishing replaces a pointer, so parts that the table has no more
    go with the version before.  kind: parquet or json.
    """
    spark = table.sparkSession
    before = published_manifest(spark, path)
    loaded = before.agg(F.sum("rows")).first()[0] or 0 if before else 0
    version = f"v-{uuid.uuid4().hex}"
    draft = f"{path}/{version}"
    try:
        table.repartitionByRange(part, *order).sortWithinPartitions(part, *order).write.partitionBy(part).option("compression", "zstd" if kind == "parquet" else "gzip").format(kind).save(f"{draft}/parts")
        want = part_sums(table, part)
        want.coalesce(1).write.parquet(f"{draft}/manifest")  # a row a part
        want = spark.read.parquet(f"{draft}/manifest")
        schema = table.select(*[c for c in table.columns if c != part], part).schema
        found = part_sums(spark.read.schema(schema).format(kind).load(f"{draft}/parts"), part)
        both = want.join(found.select("part", F.col("rows").alias("r"), F.col("digest").alias("d")), "part", "full_outer")
        wrong = both.where(~(F.col("rows").eqNullSafe(F.col("r")) & F.col("digest").eqNullSafe(F.col("d")))).select("part").limit(5).collect()
        if wrong:
            raise UnverifiedError(f"parts {[r['part'] for r in wrong]} were not written as they are")
        rows = want.agg(F.sum("rows")).first()[0] or 0
        if rows == 0 or rows < least * loaded:
            raise UnverifiedError(f"{rows} rows would replace {loaded}")
    except BaseException:
        place, files = hadoop_path(spark, draft)
        files.delete(place, True)
        raise
    publish(spark, path, version)
    return want


def read_parts(spark: SparkSession, path: str, schema: str | None = None, kind: str = "parquet") -> DataFrame:
    """The published table of write_parts()."""
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema else reader).load(f"{path}/{pointed(spark, path)}/parts")


def published_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    version = pointed(spark, path)
    return spark.read.parquet(f"{path}/{version}/manifest") if version else None


def write_objects(table: DataFrame, path: str, key: str) -> None:
    """Writes table as pretty JSON objects from key to the other columns, one object a file and task, keys in order."""
    rest = [c for c in table.columns if c != key]
    # a key as JSON: the text of an array of it, without the brackets
    name = F.regexp_extract(F.to_json(F.array(F.col(key).cast("string"))), r"(?s)^\[(.*)\]\z", 1)
    pair = table.select(key, F.concat(name, F.lit(": "), F.to_json(F.struct(*rest), {"pretty": "true"})).alias("value"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "{"
        for batch in batches:
            held = batch.column("value").to_pylist()
            if held:
                first = before if before == "{" else before + ","
                yield pa.RecordBatch.from_pydict({"value": [first, *[x + "," for x in held[:-1]]]})
                before = held[-1]
        if before != "{":
            yield pa.RecordBatch.from_pydict({"value": [before, "}"]})

    pair.repartitionByRange(key).sortWithinPartitions(key).select("value").mapInArrow(lines, "value string").write.text(path)


def key_set(words: DataFrame, path: str, most: int = 100) -> DataFrame:
    """Writes the distinct words, sorted, as one part by first letter; gives one row (keys, digest, over_length): their number, digest and how many are longer than most."""
    keys = words.select("word").distinct().withColumn("letter", F.left("word", F.lit(1)))
    manifest = write_parts(keys, path, "letter", ["word"])
    over = read_parts(words.sparkSession, path, "word string, letter string").agg(F.count_if(F.length("word") > most).alias("over_length"))
    digests: Column = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "digest"))), lambda x: x["digest"]), ""), 256)  # a row a letter
    return manifest.agg(F.sum("rows").alias("keys"), digests.alias("digest")).join(F.broadcast(over), F.lit(True))
