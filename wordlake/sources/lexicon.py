"""Canonical word tables, derived from the documents table once and then read from where they are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Splits a lower-cased text; of the pieces, which hold no other letters, _is_plain() takes those without any of ß to ÿ.
_BETWEEN = "[^a-zß-ÿ]+"


def _is_plain(piece: Column) -> Column:
    """Whether a piece is one or more of a-z: each of its characters is one byte."""
    return (piece != "") & (F.octet_length(piece) == F.length(piece))


def tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, source, w): the plain words of every document."""
    each = docs.select("doc_id", "source", F.explode(F.split(F.lower("text"), _BETWEEN)).alias("w"))
    return each.where(_is_plain(F.col("w")))


def _tallies(docs: DataFrame) -> DataFrame:
    """(w, source, n, d, own, first_doc) in rows still to be added up, of documents whose ids differ.

    A document's tokens and its distinct ones come from the row itself, so no
    row per word and document is shuffled; without an id it counts for tokens alone.
    """
    held = docs.select("doc_id", "source", F.split(F.lower("text"), _BETWEEN).alias("t"))
    kind = lambda n, t: F.struct(F.lit(n).alias("n"), t.alias("t"))
    both = held.select("doc_id", "source", F.explode(F.array(kind(1, F.col("t")), kind(0, F.array_distinct("t")))).alias("k"))
    each = both.select("doc_id", "source", "k.n", F.explode("k.t").alias("w")).where(_is_plain(F.col("w")))
    d = F.when(F.col("doc_id").isNotNull(), 1 - F.col("n")).otherwise(0)
    return each.select("w", "source", "n", d.alias("d"), d.alias("own"), F.col("doc_id").alias("first_doc"))


def _tallies_of_repeated(docs: DataFrame) -> DataFrame:
    """The same of documents that share ids: an id is one document, and counts once for a word, in one of its sources."""
    per_doc = tokens(docs).groupBy("w", "doc_id", "source").agg(F.count("*").alias("n"))
    own = F.row_number().over(Window.partitionBy("w", "doc_id").orderBy("source")) == 1
    return per_doc.select("w", "source", "n", F.lit(1).alias("d"), own.cast("int").alias("own"), F.col("doc_id").alias("first_doc"))


def _by_source(tallies: DataFrame) -> DataFrame:
    return tallies.groupBy(F.col("w").alias("word"), "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum("own").alias("own"), F.min("first_doc").alias("first_doc"))


def _by_word(rows: DataFrame) -> DataFrame:
    """A row a word, with its sources as an array, which is no longer than there are sources."""
    each = F.collect_list(F.struct("source", "n", "d", "first_doc")).alias("sources")
    lexicon = rows.groupBy("word").agg(F.sum("n").alias("n_tokens"), F.sum("own").alias("n_docs"), F.count("source").alias("n_sources"), F.min("first_doc").alias("first_doc"), each)
    intake = F.when(F.col("n_sources") >= 8, "twl").when(F.col("n_sources") >= 3, "pipeline").when((F.col("n_docs") == 1) & (F.length("word") >= 10), "synthetic").otherwise("other")
    added, invalid = F.date_add(F.lit("2025-12-17").cast("date"), (F.col("first_doc") % 60).cast("int")), F.col("first_doc") % 50 == 0
    return lexicon.select("word", "n_tokens", "n_docs", "n_sources", "first_doc", intake.alias("intake"), added.alias("added"), invalid.alias("llm_invalid"), "sources")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of words() and sources, (source, n, d, first_doc) of each; one table, which the others are cut from without a shuffle."""
    docs = table(spark, sf_dir, "documents")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")

    def build() -> DataFrame:
        shared = _tallies_of_repeated(docs.join(repeated, "doc_id", "left_semi"))
        return _by_source(_tallies(docs.join(repeated, "doc_id", "left_anti")).unionByName(shared))

    def quicker() -> DataFrame:
        return build() if repeated.take(1) else _by_source(_tallies(docs))

    return stored(docs, "lexicon", build, "word", _by_word, quicker)


def word_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(w, source, n, d, first_doc): a word's tokens, documents and smallest document in each source, kept sorted by word."""
    return lexicon(spark, sf_dir).select(F.col("word").alias("w"), F.explode("sources").alias("s")).select("w", "s.*")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, n_tokens, n_docs, n_sources, first_doc, intake, added, llm_invalid), kept sorted by word."""
    return lexicon(spark, sf_dir).drop("sources")


#: The same derivation as DuckDB SQL, for the oracles.
WORDS_SQL = r"""
tokens as (select doc_id, source, w from (select doc_id, source, unnest(regexp_split_to_array(lower(text), '[^a-zß-ÿ]+')) as w from documents) where regexp_full_match(w, '[a-z]+')),
lexicon as (select w as word, count(*)::bigint as n_tokens, count(distinct doc_id)::bigint as n_docs, count(distinct source)::bigint as n_sources, min(doc_id) as first_doc from tokens group by w),
words as materialized (select *, case when n_sources >= 8 then 'twl' when n_sources >= 3 then 'pipeline' when n_docs = 1 and length(word) >= 10 then 'synthetic' else 'other' end as intake,
    (date '2025-12-17' + (first_doc % 60)::int) as added, first_doc % 50 = 0 as llm_invalid from lexicon)"""
