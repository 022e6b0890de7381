"""Replay of an adjudication log: as one batch, or incrementally with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "ts timestamp, item_id string, event string, verdict string, instrument string"
#: Events that set an item's verdict; the first must come before any amendment.
SETS = ("verdict", "verdict_amend")


def verdict_stream(spark: SparkSession, folder: str, delay: str = "30 days") -> DataFrame:
    """The last verdict of every item in a folder of JSON lines, as files arrive; the latest ts wins, and of equal ones the greatest verdict.

    Events that set no verdict, such as searches, are counted and change nothing.
    All items are kept and late rows are taken, as any item may be amended;
    log.judged_stream() refuses second verdicts, drops late rows and forgets items.
    """
    events = spark.readStream.schema(EVENTS).json(folder).withWatermark("ts", delay)
    sets = F.when(F.col("event").isin(*SETS), F.col("ts"))
    return events.groupBy("item_id").agg(F.max(F.when(sets.isNotNull(), F.struct("ts", "verdict")))["verdict"].alias("verdict"), F.count("*").alias("events"))


def replay(events: DataFrame, order: str = "seq") -> DataFrame:
    """(item_id, verdict, amended, searches): the last verdict of each item in log order, how often it was amended, and its searches in order.

    A search has at most a few instruments an item, so the list stays short.
    """
    sets = F.when(F.col("event").isin(*SETS), F.col(order))
    found = F.sort_array(F.collect_list(F.when(F.col("event") == "search", F.struct(F.col(order), F.col("instrument")))))
    by = events.groupBy("item_id").agg(F.max_by("verdict", sets).alias("verdict"), F.count_if(F.col("event") == "verdict_amend").alias("amended"), found.alias("found"))
    return by.select("item_id", "verdict", "amended", F.transform("found", lambda s: s["instrument"]).alias("searches"))


def refused(events: DataFrame, order: str = "seq") -> DataFrame:
    """Events that a log must not take: a second verdict of an item, and an amendment of an item without a verdict."""
    first = events.where(F.col("event") == "verdict").groupBy("item_id").agg(F.min(order).alias("first"))
    own = events.where(F.col("event").isin(*SETS)).join(first, "item_id", "left")
    bad = ((F.col("event") == "verdict") & (F.col(order) > F.col("first"))) | ((F.col("event") == "verdict_amend") & (F.col("first").isNull() | (F.col(order) < F.col("first"))))
    return own.where(bad).select("item_id", order, "event")
