"""Word search: a query as data, compiled to predicates, a sort and a page."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import parse_qs, quote, urlencode

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.words import charset, glob

MODES = ("prefix", "contains", "suffix", "pattern", "regex")
SORTS = ("alpha", "length", "added")
INTAKES = ("twl", "pipeline", "synthetic", "other")
#: The keys of a query's fields in a URL.
KEYS = {"text": "q", "mode": "m", "least": "min", "most": "max", "intakes": "i", "letters": "l", "charset": "ch", "sort": "s", "descending": "d", "hide_contested": "c"}


@dataclass(frozen=True)
class Query:
    text: str = ""
    mode: str = "prefix"
    least: int | None = None
    most: int | None = None
    intakes: tuple[str, ...] = ()
    letters: tuple[str, ...] = ()
    charset: str = "any"
    hide_contested: bool = False
    sort: str = "alpha"
    descending: bool = False

    def error(self) -> str | None:
        """Why the query can't run, found before it does."""
        if self.mode == "regex" and (spark := SparkSession.getActiveSession()):
            pattern = spark.sparkContext._jvm.java.util.regex.Pattern  # the expression runs in Java
            try:
                pattern.compile(self.text.strip().lower())
            except Exception as e:
                return str(getattr(e, "java_exception", e))
        return None

    def condition(self) -> Column:
        """All filters in one predicate; text is trimmed and lower-cased, lengths are bytes, an empty list means all."""
        text, word, all_of = self.text.strip().lower(), F.col("word"), []
        if text:
            all_of.append({"prefix": word.startswith, "contains": word.contains, "suffix": word.endswith, "pattern": lambda t: glob(word, t), "regex": word.rlike}[self.mode](text))
        if self.least is not None:
            all_of.append(F.octet_length("word") >= self.least)
        if self.most is not None:
            all_of.append(F.octet_length("word") <= self.most)
        if self.intakes:
            all_of.append(F.col("intake").isin(*self.intakes))
        if self.letters:
            all_of.append(F.left("word", F.lit(1)).isin(*self.letters))
        if self.charset != "any":
            all_of.append(charset(word, self.charset))
        if self.hide_contested:
            all_of.append(~F.col("llm_invalid"))
        out = F.lit(True)
        for c in all_of:
            out = out & c
        return out

    def order(self) -> list[Column]:
        """Ties go by word, ascending even where the sort descends."""
        key = {"alpha": F.col("word"), "length": F.octet_length("word"), "added": F.col("added")}[self.sort]
        return [key.desc() if self.descending else key.asc(), F.col("word").asc()]

    def to_url(self) -> str:
        """Query string without defaults, under KEYS."""
        blank, out = Query(), {}
        for name, key in KEYS.items():
            if (value := getattr(self, name)) != getattr(blank, name):
                out[key] = ",".join(value) if isinstance(value, tuple) else ("0" if name == "hide_contested" else "1") if isinstance(value, bool) else value
        return urlencode(out, quote_via=quote)

    @staticmethod
    def from_url(text: str) -> Query:
        """Unknown values fall back to the defaults."""
        given = {k: v[0] for k, v in parse_qs(text.lstrip("?")).items()}
        number = lambda k: int(given[k]) if re.fullmatch("[0-9]+", given.get(k, "")) else None
        choice = lambda k, allowed, default: given[k] if given.get(k) in allowed else default
        many = lambda k, good: tuple(x for x in given.get(k, "").split(",") if good(x))
        return Query(
            given.get("q", ""), choice("m", MODES, "prefix"), number("min"), number("max"), many("i", INTAKES.__contains__), many("l", lambda x: re.fullmatch("[a-z]", x)),
            choice("ch", ("any", "alpha", "hyphen", "accent"), "any"), given.get("c") == "0", choice("s", SORTS, "alpha"), given.get("d") == "1",
        )


def search(words: DataFrame, query: Query) -> DataFrame:
    """Matching rows; ValueError for a query that can't run."""
    if problem := query.error():
        raise ValueError(problem)
    return words.where(query.condition())


def page(words: DataFrame, query: Query, offset: int = 0, limit: int = 240) -> DataFrame:
    """One page in the query's order: a bounded top-k, never a global sort."""
    return search(words, query).orderBy(*query.order()).offset(offset).limit(limit)


def lookup(words: DataFrame, word: str) -> DataFrame:
    """The row of a word, or none; over a table sorted by word it reads the row groups that may hold it."""
    return words.where(F.col("word") == word.strip().lower())
