"""Registered queries that write the given tables out in a format, verified, and read them back; streams; curated lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import words as fn
from ..operators import stats
from ..sources import sinks
from ..sources.files import dictionary
from ..sources.lexicon import WORDS_SQL, table, words
from ..sources.store import scratch
from ..streaming.log import load_shards, merged_shards, read_events, run_log
from . import fits  # noqa: F401  # its SQL is used here
from .features import _LOG, log_of
from .queries import ORACLE_SQL, QUERIES, on_tables, on_words, yearly


@on_words("a06_dictionary", "select word, n_tokens::varchar as n_tokens, intake, added::varchar as added from words")
def _(w):
    path = scratch(w.sparkSession, "objects")
    sinks.write_objects(w.select("word", "n_tokens", "intake", F.col("added").cast("string").alias("added")), path, "word")
    return dictionary(w.sparkSession, path, ("n_tokens", "intake", "added"))


_FNV = ORACLE_SQL["k40_fnv_shards"]


@on_tables("b08_shard_files", f"select shard, count(*) as rows, sum(length(word))::bigint as letters, min(word) as first, max(word) as last from (select word, shard from ({_FNV})) group by shard")
def _(spark, sf_dir):
    path = scratch(spark, "shards")
    sinks.write_parts(words(spark, sf_dir).select("word", "n_tokens", (fn.fnv1a(F.col("word")) % 512).cast("int").alias("shard")), path, "shard", ["word"], kind="json")
    back = sinks.read_parts(spark, path, "word string, n_tokens long, shard int", "json")
    return back.groupBy("shard").agg(F.count("*").alias("rows"), F.sum(F.length("word")).alias("letters"), F.min("word").alias("first"), F.max("word").alias("last"))


@on_words("b12_list_files", "select 'human' as list, word from words where intake <> 'synthetic' union all select 'tournament', word from words where intake = 'twl'")
def _(w):
    lists = F.explode(F.array_compact(F.array(F.when(F.col("intake") != "synthetic", "human"), F.when(F.col("intake") == "twl", "tournament"))))
    path = scratch(w.sparkSession, "lists")
    sinks.write_parts(w.select("word", lists.alias("list")), path, "list", ["word"])
    return sinks.read_parts(w.sparkSession, path, "word string, list string").select("list", "word")


@on_words("b15_length_files", "select length(word)::int as length, count(*) as rows, min(word) as first, max(word) as last, count(*) filter (intake = 'twl') as listed from words where length(word) between 2 and 35 group by 1")
def _(w):
    path = scratch(w.sparkSession, "lengths")
    manifest = sinks.write_parts(w.where(F.length("word").between(2, 35)).select("word", "intake", F.length("word").alias("length")), path, "length", ["word"])
    back = sinks.read_parts(w.sparkSession, path, "word string, intake string, length int")
    by = back.groupBy("length").agg(F.min("word").alias("first"), F.max("word").alias("last"), F.count_if(F.col("intake") == "twl").alias("listed"))
    return by.join(manifest.select(F.col("part").cast("int").alias("length"), "rows"), "length").select("length", "rows", "first", "last", "listed")


@on_words("b20_key_set", "select count(*) as keys, count(*) filter (length(word) > 100) as over_length from words")
def _(w):
    return sinks.key_set(w, scratch(w.sparkSession, "keys")).select("keys", "over_length")


@on_tables("b04_distribution_files", f"with {WORDS_SQL} select length(word)::varchar as key, count(*) as n from words group by 1")
def _(spark, sf_dir):
    from ..sources.files import distribution

    path = scratch(spark, "lengths")
    by = words(spark, sf_dir).groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    by.coalesce(1).sort("length").write.csv(path, header=True)  # a row a length
    return distribution(spark, path)


@on_tables("m02_stream_refused", ORACLE_SQL["m02_refused_events"])
def _(spark, sf_dir):
    folder, out, checkpoint = (scratch(spark, x) for x in ("events", "judged", "checkpoint"))
    log_of(spark, sf_dir).select("seq", F.timestamp_seconds(1_700_000_000 + F.col("seq")).alias("ts"), F.col("item_id").cast("string").alias("item_id"), "event", "verdict", "instrument").write.json(folder)
    run_log(read_events(spark, folder), out, checkpoint)
    return spark.read.parquet(out).where("status = 'refused'").select(F.col("item_id").cast("long").alias("item_id"), "seq", "event")


@on_tables(
    "m03_stream_cooldown",
    f"with l as ({_LOG}), e as (select item_id, max(seq) as last from l group by item_id) select item_id, last from e where last + 2 * 24 <= (select max(seq) from l) - 24",
)
def _(spark, sf_dir):
    folder, out, checkpoint = (scratch(spark, x) for x in ("events", "judged", "checkpoint"))
    # an event an hour; items without an event for two days before the watermark, which is a day behind
    log_of(spark, sf_dir).select("seq", F.timestamp_seconds(1_700_000_000 + 3600 * F.col("seq")).alias("ts"), F.col("item_id").cast("string").alias("item_id"), "event", "verdict", "instrument").write.json(folder)
    run_log(read_events(spark, folder), out, checkpoint, delay="1 day", days=2)
    gone = spark.read.parquet(out).where("status = 'expired'")
    return gone.select(F.col("item_id").cast("long").alias("item_id"), ((F.unix_timestamp("ts") - 1_700_000_000) / 3600).cast("long").alias("last"))


@on_tables("m05_sharded_ingest", ORACLE_SQL["f13_corpus_aggregate"])
def _(spark, sf_dir):
    folder, out, checkpoint = (scratch(spark, x) for x in ("shards", "loaded", "checkpoint"))
    triple = F.concat_ws(",", "year", "match", "volume")
    lines = yearly(spark, sf_dir).groupBy("w").agg(F.concat_ws("\t", F.collect_list(triple)).alias("t"))  # a number a source
    lines.repartitionByRange(8, "w").select(F.concat_ws("\t", "w", "t")).write.text(folder)
    load_shards(spark, folder, out, checkpoint, shards_at_a_time=2)
    return merged_shards(spark, out)


#: Share of a bucket's words that may be taken at most, as one in so many.
_CAP = 3
_GOALS = f"""c as (select word[1] as bucket, count(*) as n, count(*) // {_CAP} as cap from words group by 1), t as (select (0.3 * sum(n))::bigint as target from c),
q as (select bucket, n, cap, n * target / sum(n) over () as exact, least(cap, floor(n * target / sum(n) over ()))::bigint as whole, target from c, t),
r as (select *, target - sum(whole) over () as remaining, cap > whole as room from q),
s as (select *, case when room and row_number() over (partition by room order by exact - whole desc, bucket) <= remaining then 1 else 0 end as one from r),
u as (select *, remaining - sum(one) over () as rest, cap - whole - one as space from s),
k as (select bucket, unnest(range(1, space + 1)) as round from u), v as (select bucket, round, row_number() over (order by round, bucket) as turn from k),
goals as (select bucket, n, cap, whole + one + (select count(*) from v where v.bucket = u.bucket and turn <= rest) as goal from u)"""


def _goals(w):
    """(bucket, n, cap, goal): three tenths of all words, dealt to first letters, no more than a third of any."""
    by = w.groupBy(F.left("word", F.lit(1)).alias("bucket")).agg(F.count("*").alias("n"), F.floor(F.count("*") / _CAP).alias("cap"))
    target = by.agg(F.round(F.sum("n") * 0.3).cast("long")).first()[0] or 0  # of a few letters
    return stats.allocation(by, target, "cap")


@on_words("g06_bounded_allocation", f", {_GOALS} select bucket, n, cap, goal::bigint as goal from goals")
def _(w):
    return _goals(w)


@on_tables(
    "g04_curated",
    f"with {WORDS_SQL}, {_GOALS}, scored as ({ORACLE_SQL['k35_quality']}), ranked as (select word, quality, row_number() over (partition by word[1] order by quality desc, sha256('tie:' || word), word) as rank from scored) select word, quality, rank::int as rank from ranked join goals on bucket = word[1] where rank <= goal",
)
def _(spark, sf_dir):
    scored = QUERIES["k35_quality"](spark, sf_dir).withColumn("letter", F.left("word", F.lit(1))).withColumn("tie", F.sha2(F.concat(F.lit("tie:"), "word"), 256))
    return stats.best_of_buckets(scored, _goals(words(spark, sf_dir)), "letter", "quality", "tie", "word").select("word", "quality", "rank")


@on_words("k44_iso_times", "select word, added::varchar || 'T00:00:00Z' as at from words")
def _(w):
    return w.select("word", fn.iso_utc(F.col("added").cast("timestamp")).alias("at"))
