"""Tables derived once from the input tables, kept sorted beside the session's shared folder, and read with pruning."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Files of a sorted table for each core, so that a round of tasks seldom waits for a last one; a row group holds so many bytes.
FILES_A_CORE = 3
ROW_GROUP = 8 << 20
#: Bytes of the source for each file at most, so that what a task sorts grows no further with the source, and needs no spill.
SOURCE_A_FILE = 64 << 20
#: The file in a place's folder that names its published version.
POINTER = "_current"


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="wordlake-store-")


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; where it is unset, a temporary folder on a local master alone."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{given or _own_folder()}/wordlake"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder; it goes when the application ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    place, files = hadoop_path(spark, path)
    files.deleteOnExit(place)
    return path


def hadoop_path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointed(spark: SparkSession, place: str) -> str | None:
    """The version that place's pointer names, or None; what an unfinished writer left behind does not count."""
    path, files = hadoop_path(spark, f"{place}/{POINTER}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, place: str, version: str) -> None:
    """Points place at version, and removes the version before; drafts of other writers stay."""
    before = pointed(spark, place)
    path, files = hadoop_path(spark, f"{place}/{POINTER}")
    stream = files.create(path, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    if before and before != version:
        old, files = hadoop_path(spark, f"{place}/{before}")
        files.delete(old, True)


def files_of(df: DataFrame) -> list[tuple[str, int, int]]:
    """Names, sizes and times of the files that df reads."""
    spark, seen = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path, files = hadoop_path(spark, name)
        status = files.getFileStatus(path)
        seen.append((name, status.getLen(), status.getModificationTime()))
    return seen


def fingerprint(df: DataFrame) -> str:
    return hashlib.sha256(repr(files_of(df)).encode()).hexdigest()[:24]


def derivation(df: DataFrame) -> str:
    """A hash of how df is made: its plan without the numbers of this session's expressions; variables of lambdas are told apart by their order."""
    plan, seen = df._jdf.queryExecution().analyzed().toString(), {}
    plan = re.sub(r"lambda \w+#\d+L?", lambda m: f"lambda {seen.setdefault(m[0], len(seen))}", plan)
    return hashlib.sha256(re.sub(r"#\d+L?", "", plan).encode()).hexdigest()[:12]


def stored(source: DataFrame, name: str, build: Callable[[], DataFrame], key: str, gather: Callable[[DataFrame], DataFrame] | None = None, quicker: Callable[[], DataFrame] | None = None) -> DataFrame:
    """The table that build() makes of source, sorted by key over range partitions; built again when source's files or the derivation change.

    gather, if given, groups the rows by key once they are dealt by it.  quicker,
    if given, makes the same rows as build() after a look at the data; it runs
    only where the table is missing.  The table is written under a name of its
    own and then pointed at, so a reader meets neither half a table nor what a
    broken-off writer left.
    """
    spark, made = source.sparkSession, build()
    gather = gather or (lambda df: df)
    place = f"{folder(spark)}/{name}-{fingerprint(source)}-{derivation(gather(made))}"
    version = pointed(spark, place)
    if version is None:
        version = f"v-{uuid.uuid4().hex}"
        made = quicker() if quicker else made
        parts = max(FILES_A_CORE * spark.sparkContext.defaultParallelism, -(-sum(size for _, size, _ in files_of(source)) // SOURCE_A_FILE))
        gather(made.repartitionByRange(parts, key)).sortWithinPartitions(key).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(f"{place}/{version}")
        other = pointed(spark, place)  # made meanwhile, and equal
        if other is None:
            publish(spark, place, version)
        else:
            own, files = hadoop_path(spark, f"{place}/{version}")
            files.delete(own, True)
            version = other
    return spark.read.parquet(f"{place}/{version}")
