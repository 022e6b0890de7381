"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame.

All stages but the last return the columns of documents.  run() writes each
stage's result as Parquet to the shared folder and reads it as the next one's
documents.  Rows are told apart by numbers of their own within each stage, so
null or repeated ids neither lose nor join rows; texts may be null, empty or
very long; an empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession

from wordlake.llm.common import drop_saved, save
from wordlake.llm.exact_dedup import drop_copies
from wordlake.llm.near_dedup import drop_near_copies
from wordlake.llm.packing import pack_documents
from wordlake.llm.secrets import mask_secrets
from wordlake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; those without words stay, unless most labelled ones are toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays; null, empty and blank texts are equal."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; a document without words is near to none."""
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows it; every row stays, a null text as null."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces with places in training sequences; a null or empty text is one piece, its end id."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing)]
#: Learned scores and tokenisation are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        made = save(stage(spark, docs, sf_dir))
        drop_saved(docs)  # the stage before; the input is no table of save()
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
