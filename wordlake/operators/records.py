"""Dictionary records (JSON objects of varying shape) reduced to facts, provenance, strata and outcomes.

All functions are Column expressions over a parsed record; a missing or
ill-shaped field is null and never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the reductions read of a record; other fields are not parsed.
RECORD = (
    "source string, validation_source string, added_date string, created_date string, validation_date string, unverified_llm_verdict string, status string, "
    "candidate_source array<string>, advanced_validation struct<passed: boolean, confidence: double>, statistical_validation struct<passed: boolean, confidence: double>, "
    "manual_validation struct<manual_validation_source: string, manual_validation_status: string>, category string, definition string, etymology string, pronunciation string, raw_response string"
)
#: Sources whose word settles a listing.
AUTHORITATIVE = ("merriam_webster_collegiate", "merriam_webster_medical", "free_dictionary")
PAYLOAD = "array<struct<meta: struct<id: string, stems: array<string>, section: string>, hwi: struct<hw: string>, fl: string, shortdef: array<string>>>"


def parse(records: DataFrame, column: str = "rec") -> DataFrame:
    """records with its JSON column parsed."""
    return records.withColumn(column, F.from_json(column, RECORD))


def intake_of(rec: Column) -> Column:
    return F.when(rec["source"] == "twl_scrabble_dictionary", "twl").when(rec["source"] == "synthetic_generation", "synthetic").when(rec["validation_source"] == "verification_pipeline", "pipeline").otherwise("other")


def day(text: Column) -> Column:
    """The day of a date or timestamp text, null for any other."""
    return F.when(F.left(text, F.lit(10)).rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.left(text, F.lit(10)))


def added_of(rec: Column) -> Column:
    return F.coalesce(*[day(rec[c]) for c in ("added_date", "created_date", "validation_date")])


def llm_says_invalid(rec: Column) -> Column:
    """By the new field's name, else the old one's."""
    return F.coalesce(F.coalesce(rec["unverified_llm_verdict"], rec["status"]) == "invalid", F.lit(False))


def clean(text: Column) -> Column:
    """A definition without markup: links become their last part, other codes go, white space is one space; null if nothing is left."""
    for pattern, to in ((r"\{(et_link|d_link)\|[^|}]*\|([^}]*)\}", "$2"), (r"\{[^}]*\}", ""), (r"\s+", " ")):
        text = F.regexp_replace(text, pattern, to)
    return F.nullif(F.trim(text), F.lit(""))


def by_suffix(names: Column, suffix: str) -> Column:
    """The names that end in suffix, without it."""
    return F.transform(F.filter(names, lambda s: s.endswith(suffix)), lambda s: F.left(s, F.length(s) - len(suffix)))


def status_code(status: Column) -> Column:
    return F.when(status == "valid", 1).when(status == "invalid", 2).otherwise(0)


def evidence_of(rec: Column) -> Column:
    """The names of the evidence on record, joined by '+', or none."""
    named = [F.when(F.nullif(rec[c], F.lit("")).isNotNull(), F.lit(c)) for c in ("raw_response", "definition", "etymology", "pronunciation")]
    return F.coalesce(F.nullif(F.concat_ws("+", *named), F.lit("")), F.lit("none"))


def stage2(rec: Column) -> list[Column]:
    """stratum, n_valid_sources, all_unlikely, pipeline_checks_passed of a record."""
    sources = F.coalesce(rec["candidate_source"], F.array().cast("array<string>"))
    n = F.size(F.filter(sources, lambda s: s.endswith("_valid")))
    checks = F.filter(F.array(*[F.when(rec[c].isNotNull(), F.coalesce(rec[c]["passed"], F.lit(False))) for c in ("advanced_validation", "statistical_validation")]), lambda x: x.isNotNull())
    return [
        F.when(n >= 4, "4+").otherwise(n.cast("string")).alias("stratum"),
        n.alias("n_valid_sources"),
        ((F.size(sources) > 0) & F.forall(sources, lambda s: s.endswith("_unlikely"))).alias("all_unlikely"),
        ((F.size(checks) > 0) & F.forall(checks, lambda x: x)).alias("pipeline_checks_passed"),
    ]


def outcome(deciding: Column, statuses: Column) -> Column:
    """refuted, corroborated, unadjudicated or error, from the deciding status and the array of all sources' statuses."""
    consulted = F.filter(statuses, lambda s: ~s.isin("unconfigured", "not_consulted"))
    return (
        F.when(deciding == "valid", "refuted").when(deciding.isin("abbreviation", "proper_noun"), "corroborated")
        .when((F.size(consulted) > 0) & F.forall(consulted, lambda s: s == "error"), "error")
        .when(F.exists(consulted, lambda s: s == "not_found"), "unadjudicated").otherwise("error")
    )


def deciding(statuses: Column) -> Column:
    """The first status, in the sources' order, that rules on the word."""
    return F.get(F.filter(statuses, lambda s: s.isin("valid", "abbreviation", "proper_noun")), F.lit(0))


def inflections(status: Column, forms: Column, stems: Column, statuses: Column) -> list[Column]:
    """outcome, and the forms that the headword's entry lists and lacks."""
    low = F.transform(F.coalesce(stems, F.array().cast("array<string>")), F.lower)
    listed = F.filter(forms, lambda f: F.array_contains(low, F.lower(f)))
    kind = (
        F.when(status == "valid", F.when(F.size(listed) > 0, "inflection-listed").when(F.size(low) > 0, "inflection-absent").otherwise("no-stems-array"))
        .when(status.isNotNull(), "inflection-absent").when(F.exists(statuses, lambda s: s == "not_found"), "mw-absent").otherwise("error")
    )
    none = F.array().cast("array<string>")
    missing = F.when(status == "valid", F.filter(forms, lambda f: ~F.array_contains(low, F.lower(f)))).when(status.isNotNull(), forms).otherwise(none)
    return [kind.alias("outcome"), F.when(status == "valid", listed).otherwise(none).alias("listed"), missing.alias("missing")]


def pos_stratum(pos: Column) -> Column:
    """wn-adj, wn-other or not-in-wn from an array of parts of speech."""
    return F.when(F.size(pos) == 0, "not-in-wn").when(F.arrays_overlap(pos, F.array(F.lit("a"), F.lit("s"))), "wn-adj").otherwise("wn-other")


def repaired(status: Column) -> Column:
    """An enum's own spelling becomes its value."""
    return F.when(status == "WordStatus.VALID", "valid").otherwise(status)


def payload_verdict(word: Column, payload: Column) -> Column:
    """not_found, abbreviation, proper_noun or valid, from a dictionary's JSON answer.

    Suggestions (an array of texts) and an empty answer are not found.  The
    first entry that matches the word decides: by its id before ':', its
    headword without syllable marks, or any of its stems.
    """
    entries = F.filter(F.coalesce(F.from_json(payload, PAYLOAD), F.array().cast(PAYLOAD)), lambda e: e["meta"].isNotNull() | e["hwi"].isNotNull())
    low = F.lower(word)
    head = lambda e: F.replace(F.coalesce(e["hwi"]["hw"], F.lit("")), F.lit("*"), F.lit(""))
    stems = lambda e: F.coalesce(e["meta"]["stems"], F.array().cast("array<string>"))
    matches = lambda e: (F.lower(F.substring_index(F.coalesce(e["meta"]["id"], F.lit("")), ":", 1)) == low) | (F.lower(head(e)) == low) | F.exists(stems(e), lambda s: F.lower(s) == low)
    entry = F.get(F.filter(entries, matches), F.lit(0))
    name = head(entry)
    caps = (F.upper(name) == name) & name.rlike("[A-Z]")
    return (
        F.when(entry.isNull(), "not_found")
        .when(F.lower(F.coalesce(entry["fl"], F.lit(""))).contains("abbreviation") | (caps & (F.length(name) > 1)), "abbreviation")
        .when((name.rlike("^[A-Z]") & ~caps) | F.coalesce(entry["meta"]["section"], F.lit("")).isin("biog", "geog"), "proper_noun")
        .otherwise("valid")
    )


def stage1(dual: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, source, evidence, resolved) of words on both lists; resolved if an authoritative source stands behind the word."""
    found = dual.select("word").join(dictionary, "word", "left")
    return found.select("word", F.col("rec.source").alias("source"), evidence_of(F.col("rec")).alias("evidence"), F.coalesce(F.col("rec.source").isin(*AUTHORITATIVE), F.lit(False)).alias("resolved"))


# what a dictionary's answer says, null where its shape is another


def _first_text(items: Column) -> Column:
    """The second part of the first item whose first part is "text", of a JSON array of arrays."""
    parts = F.from_json(items, "array<array<string>>")
    return F.get(F.filter(parts, lambda x: F.get(x, F.lit(0)) == "text"), F.lit(0))[1]


def definition_of(entry: Column) -> Column:
    """The first definition of an entry (JSON text), without its codes; null where the path to it breaks off."""
    sense = F.get_json_object(entry, "$.def[0].sseq[0][0][1].dt")
    text = _first_text(sense)
    for code in ("{bc}", "{sx|", "||}"):
        text = F.replace(text, F.lit(code), F.lit(""))
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def etymology_of(entry: Column) -> Column:
    """The first text of an entry's etymology."""
    return _first_text(F.get_json_object(entry, "$.et"))


def pronunciation_of(entry: Column) -> Column:
    """The first pronunciation of an entry."""
    return F.get_json_object(entry, "$.hwi.prs[0].mw")


def relabelled(rec: Column, status: Column) -> list[Column]:
    """(checked_verdict, unverified_verdict): a status is a verdict that somebody checked where the record has a manual_validation, else an unverified one."""
    manual = F.get_json_object(rec, "$.manual_validation").isNotNull()
    return [F.when(manual, status).alias("checked_verdict"), F.when(~manual, status).alias("unverified_verdict")]


def with_definition(word: Column, definition: Column) -> Column:
    """A word's entry: the definition only if something is left of it without blanks around it."""
    return F.struct(word.alias("word"), F.nullif(F.regexp_replace(definition, r"^\s+|\s+\z", ""), F.lit("")).alias("definition"))
