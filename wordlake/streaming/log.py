"""An adjudication log as a stateful stream, and shard files loaded one after the other."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.files import counts_of_lines

EVENTS = "seq long, ts timestamp, item_id string, event string, verdict string, instrument string"
JUDGED = "item_id string, seq long, at long, event string, verdict string, status string"
#: Days after which an item may be judged anew.
COOLDOWN_DAYS = 180


class Adjudication(StatefulProcessor):
    """Keeps each item's verdict and the time of its last event; takes or refuses events, and forgets items after the cooldown.

    Times are whole microseconds (at), since pandas holds none after 2262.
    """

    def __init__(self, days: float) -> None:
        self.span = int(timedelta(days=days) / timedelta(microseconds=1))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.item = handle.getValueState("item", "verdict string, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        events = sorted(rows, key=lambda r: (r["at"], r["seq"] is None, r["seq"] or 0))
        verdict, last = self.item.get() if self.item.exists() else (None, None)
        held = verdict is not None
        for r in events:
            taken = True
            if r["event"] == "verdict":
                taken = not held
            elif r["event"] == "verdict_amend":
                taken = held
            if taken and r["event"] in ("verdict", "verdict_amend"):
                verdict, held = r["verdict"], True
            yield Row(item_id=key[0], seq=r["seq"], at=r["at"], event=r["event"], verdict=r["verdict"], status="taken" if taken else "refused")
        newest = max(x for x in (events[-1]["at"], last) if x is not None)
        self.item.update((verdict if held else None, newest))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((newest + self.span) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.item.exists():
            verdict, last = self.item.get()
            self.item.clear()
            yield Row(item_id=key[0], seq=None, at=last, event="cooldown", verdict=verdict, status="expired")

    def close(self) -> None:
        pass


def judged_stream(events: DataFrame, delay: str = "30 days", days: float = COOLDOWN_DAYS) -> DataFrame:
    """events (EVENTS), a stream, with a status each: taken or refused; and a row `expired` for an item that had no event for so many days.

    A verdict is refused if its item has one, an amendment if its item has none.
    An item's events of one batch are ordered by ts and seq, so a batch holds
    them in memory; rows later than the delay are dropped.  State is kept in the
    query's checkpoint, and a restarted query goes on from it.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = events.where("item_id is not null and ts is not null").withWatermark("ts", delay).withColumn("at", F.unix_micros("ts"))
    judged = timed.groupBy("item_id").transformWithState(Adjudication(days), JUDGED, "Append", "EventTime")
    return judged.select("item_id", "seq", F.timestamp_micros("at").alias("ts"), "event", "verdict", "status")


def read_events(spark: SparkSession, folder: str, files_at_a_time: int | None = None) -> DataFrame:
    """The stream of a folder of JSON lines, in the order in which files arrive."""
    reader = spark.readStream.schema(EVENTS)
    return (reader.option("maxFilesPerTrigger", files_at_a_time) if files_at_a_time else reader).json(folder)


def run_log(events: DataFrame, out: str, checkpoint: str, delay: str = "30 days", days: float = COOLDOWN_DAYS) -> None:
    """Judges all events that have arrived, and appends the rows to Parquet files in out; run again, it goes on where it stopped."""
    judged_stream(events, delay, days).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def load_shards(spark: SparkSession, folder: str, out: str, checkpoint: str, shards_at_a_time: int = 1, after=None) -> None:
    """Aggregates shard files of counts (see yearly_counts) into out, some at a time: (w, total_match, total_volume, first_year, last_year, years).

    A shard that the checkpoint knows is not read again; one whose load broke off
    is loaded again into the same place, so no shard counts twice.  `after`, if
    given, is called with the number of each finished batch.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", shards_at_a_time).text(folder)

    def load(batch: DataFrame, number: int) -> None:
        by = counts_of_lines(batch).groupBy("w").agg(F.sum("match").alias("total_match"), F.sum("volume").alias("total_volume"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("years"))
        by.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if after:
            after(number)

    lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def merged_shards(spark: SparkSession, out: str) -> DataFrame:
    """(w, total_match, total_volume, first_year, last_year, year_count) over all shards; years are no more than the span."""
    span = F.max("last_year") - F.min("first_year") + 1
    return spark.read.parquet(out).groupBy("w").agg(F.sum("total_match").alias("total_match"), F.sum("total_volume").alias("total_volume"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.least(F.sum("years"), span).alias("year_count"))
