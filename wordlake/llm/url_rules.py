"""URL filtering by pattern rules that are indexed by their rarest literal token.

Each rule is a regular expression over host and path together with the whole
literal tokens that any URL it matches must hold.  A rule is filed under the one of its
tokens that is rarest among the URLs; a URL's tokens fetch candidate rules by an
equi-join, and only those candidates run their expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns_of

#: (verdict, rule) as host and path; a rule covers the host with all its subdomains, and paths that start with its path.
SITE_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: (verdict, expression over host and path, literal tokens that every match holds), for URLs that no site rule fits.
PATTERN_RULES = (
    ("block", r"(^|[./-])ads?[./-].*/banner([^A-Za-z0-9]|$)", ("banner",)),
    ("block", r"/(click|track|pixel)/redirect([^A-Za-z0-9]|$)", ("redirect",)),
    ("block", r"^([^/]*[.-])?casino[.-][^/]*/", ("casino",)),
    ("block", r"/wp-login\.php$", ("wp", "login", "php")),
)
TOKEN = "[A-Za-z0-9]+"
#: Rules up to which they, and their index, are broadcast (some hundred bytes each); beyond it they are shuffled, in SALTS parts a token.
BROADCAST_RULES, SALTS = 50_000, 32


def site_rules(spark: SparkSession, rules=SITE_RULES) -> DataFrame:
    """Rows (rule, verdict, pattern, tokens, rank) of host/path rules; a longer rule has a higher rank."""
    rows = []
    for rank, (verdict, rule) in enumerate(sorted(rules, key=lambda r: (len(r[1]), r[1])), start=1):
        host, _, path = rule.partition("/")
        pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}"
        rows.append((rule, verdict, pattern, sorted(set(re.findall(TOKEN, host.lower()))), rank))
    return spark.createDataFrame(rows, "rule string, verdict string, pattern string, tokens array<string>, rank int")


def pattern_rules(spark: SparkSession, rules=PATTERN_RULES) -> DataFrame:
    """Rows like those of site_rules(), with ranks below zero: any site rule goes before them; earlier ones go first.

    The tokens are whole ones (runs of TOKEN) that every match holds, letter case included; a rule without tokens is tried on every URL.
    """
    rows = [(None, verdict, pattern, sorted(set(tokens)), -i) for i, (verdict, pattern, tokens) in enumerate(rules, start=1)]
    return spark.createDataFrame(rows, "rule string, verdict string, pattern string, tokens array<string>, rank int")


def host_and_path(url: str):
    """Columns (host, path) of a URL column: the host after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; the path up to '?', '#' or the end."""
    rest = F.regexp_extract(F.col(url), r"^(?s:.*?)://([^?#]*)", 1)
    host = F.regexp_extract(rest, "^[^/]*", 0)
    path = F.regexp_extract(rest, "^[^/]*((?s:.*))$", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), F.coalesce(path, F.lit(""))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A null URL or one without '://' has an empty host and path.  The rule of the
    highest rank among those that match gives the verdict (of equal ranks the
    greatest rule), default where none does.  Each row counts by itself: repeated
    rows and null ids stay.  Rules without tokens are tried on every URL; rules
    may not share a rank with another verdict.  Other columns of pages are not
    read, and an empty table gives an empty result.
    """
    host, path = host_and_path("url")
    seen = columns_of(pages, id_col, url_col).toDF("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    tokens = F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({TOKEN})"), F.lit(1)))
    few = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    small = F.broadcast if few else lambda df: df
    # the empty token stands on every URL, for the rules without tokens
    seen = seen.select(F.monotonically_increasing_id().alias("uid"), "*", F.array_append(tokens, F.lit("")).alias("tokens"))
    held = rules.select("rank", "pattern", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))

    counts = seen.select(F.explode("tokens").alias("token")).join(small(held.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    index = held.join(counts, "token", "left").groupBy("rank", "pattern").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest")).select("rank", F.col("pattern").alias("__pattern"), F.col("rarest.token").alias("token"))

    fetched, keys = seen.select("uid", "page_id", "host", "path", F.explode("tokens").alias("token")), ["token"]
    if not few:
        fetched, keys = fetched.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS))), ["token", "salt"]
        index = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    fits = F.when(F.rlike(F.concat("host", "path"), F.col("__pattern")), F.col("rank"))
    best = fetched.join(small(index), keys, "left").groupBy("uid", "page_id", "host", "path").agg(F.max(fits).alias("rank"))
    given = rules.groupBy("rank").agg(F.max("rule").alias("rule"), F.max("verdict").alias("given"))
    return best.join(small(given), "rank", "left").select("page_id", "host", "path", "rule", F.coalesce("given", F.lit(default)).alias("verdict"))
