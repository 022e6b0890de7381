"""Registered queries over dictionary records, which are derived from the words and their sources as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lists
from ..operators import records as rec
from ..operators import stats
from ..sources.lexicon import WORDS_SQL, lexicon, table, word_sources, words
from .queries import _LISTS, _ORDINAL, _valid_invalid, on_tables

#: The fields of a record, as SQL over the words table that either engine reads.
FIELDS = {
    "source": "case first_doc % 5 when 0 then 'twl_scrabble_dictionary' when 1 then 'synthetic_generation' when 2 then 'merriam_webster_collegiate' end",
    "validation_source": "case when first_doc % 5 = 3 then 'verification_pipeline' end",
    "added_date": "case when n_docs % 3 = 0 then cast(added as varchar(10)) end",
    "created_date": "case when n_docs % 3 = 1 then cast(added as varchar(10)) || 'T08:00:00Z' end",
    "validation_date": "case when n_docs % 4 = 2 then '2025' end",
    "unverified_llm_verdict": "case n_tokens % 7 when 0 then 'invalid' when 1 then 'valid' end",
    "status": "case n_tokens % 5 when 0 then 'invalid' when 1 then 'WordStatus.VALID' else 'valid' end",
    "category": "case when first_doc % 5 = 1 then 'blend' end",
    "definition": "case when n_docs % 2 = 0 then '{bc}a {it}kind{/it} of  {et_link|' || word || ':1|' || word || '} thing' when n_docs % 9 = 3 then '{bc} ' end",
    "etymology": "case when n_docs % 5 = 0 then 'from ' || word end",
}
_FIELDS = ", ".join(f"{sql} as {name}" for name, sql in FIELDS.items())
RECORDS_SQL = f"""{WORDS_SQL}, r as (select word, n_tokens, n_docs, n_sources, first_doc, {_FIELDS} from words),
named as (select w as word, list(source || case when {_ORDINAL} % 3 = 0 then '_unlikely' else '_valid' end order by source || case when {_ORDINAL} % 3 = 0 then '_unlikely' else '_valid' end) as candidate_source from (select distinct w, source from tokens) group by w)"""
_DAY = "case when regexp_full_match(left({0}, 10), '\\d{{4}}-\\d{{2}}-\\d{{2}}') then left({0}, 10) end"
_INTAKE = "case when source = 'twl_scrabble_dictionary' then 'twl' when source = 'synthetic_generation' then 'synthetic' when validation_source = 'verification_pipeline' then 'pipeline' else 'other' end"
_CLEAN = "nullif(trim(regexp_replace(regexp_replace(regexp_replace(definition, '\\{(et_link|d_link)\\|[^|}]*\\|([^}]*)\\}', '\\2', 'g'), '\\{[^}]*\\}', '', 'g'), '\\s+', ' ', 'g')), '')"


def records(spark: SparkSession, sf_dir: str, least: int = 1) -> DataFrame:
    """(word, rec): one JSON object a word of so many tokens at least, made of the word's own row; fields without a value are absent."""
    number = lambda s: F.substring(s, 4, 9).cast("int")
    name = lambda s: F.concat(s["source"], F.when(number(s["source"]) % 3 == 0, "_unlikely").otherwise("_valid"))
    named = F.sort_array(F.array_compact(F.transform("sources", name))).alias("candidate_source")
    own = lexicon(spark, sf_dir).where(F.col("n_tokens") >= least)
    passed = lambda c, n, confidence: F.struct((F.col(c) % n == 0).alias("passed"), confidence.alias("confidence"))
    more = [
        F.when(F.col("n_docs") % 2 == 1, passed("n_tokens", 2, F.col("n_tokens") % 100 / 100.0)).alias("advanced_validation"),
        F.when(F.col("n_docs") % 4 < 2, passed("n_tokens", 3, F.col("n_docs") % 10 / 10.0)).alias("statistical_validation"),
    ]
    return own.select("word", F.to_json(F.struct(*[F.expr(sql).alias(name) for name, sql in FIELDS.items()], named, *more)).alias("rec"))


def on_records(name: str, sql: str):
    """Registers a function of the parsed records; sql may use r, named, words and tokens."""

    def register(f):
        return on_tables(name, f"with {RECORDS_SQL} {sql}")(lambda spark, sf_dir: f(rec.parse(records(spark, sf_dir)), F.col("rec")))

    return register



@on_records("d01_facts", f"select word, {_INTAKE} as intake, coalesce({_DAY.format('added_date')}, {_DAY.format('created_date')}, {_DAY.format('validation_date')}) as added, coalesce(coalesce(unverified_llm_verdict, status) = 'invalid', false) as llm_invalid from r")
def _(d, r):
    return d.select("word", rec.intake_of(r).alias("intake"), rec.added_of(r).alias("added"), rec.llm_says_invalid(r).alias("llm_invalid"))


@on_tables("d04_flags", f"with {RECORDS_SQL}, {_LISTS}, f as (select word, {_INTAKE} as intake, coalesce(coalesce(unverified_llm_verdict, status) = 'invalid', false) as bad from r where n_tokens >= 2), p as (select distinct t as word from (select unnest(string_split(lower(text), ' ')) as t from documents) where t <> '') select p.word, coalesce(f.intake, 'other') as intake, (case when f.bad then 1 else 0 end + case when exists (select 1 from invalid i where i.word = p.word) then 2 else 0 end + case when not regexp_full_match(p.word, '[a-z]+') then 4 else 0 end)::int as flags from p left join f on f.word = p.word")
def _(spark, sf_dir):
    listed = table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).where("word <> ''").distinct()
    facts = rec.parse(records(spark, sf_dir, least=2)).select("word", rec.intake_of(F.col("rec")).alias("intake"), rec.llm_says_invalid(F.col("rec")).alias("bad"))
    invalid = _valid_invalid(words(spark, sf_dir))[1].withColumn("also", F.lit(True))
    bit = lambda c, n: F.when(c, n).otherwise(0)
    flags = bit(F.col("bad"), 1) + bit(F.col("also"), 2) + bit(~F.col("word").rlike(r"^[a-z]+\z"), 4)
    return listed.join(facts, "word", "left").join(invalid, "word", "left").select("word", F.coalesce("intake", F.lit("other")).alias("intake"), flags.alias("flags"))


@on_records("d07_provenance", f"select word, array_to_string(list_transform(list_filter(candidate_source, lambda s: ends_with(s, '_valid')), lambda s: left(s, length(s) - 6)), '+') as attested, array_to_string(list_transform(list_filter(candidate_source, lambda s: ends_with(s, '_unlikely')), lambda s: left(s, length(s) - 9)), '+') as unlikely, case when n_docs % 2 = 1 then (n_tokens % 100)::int end as confidence, case status when 'valid' then 1 when 'invalid' then 2 else 0 end as code, category, {_CLEAN} as definition from r join named using (word)")
def _(d, r):
    sources = r["candidate_source"]
    return d.select(
        "word", F.array_join(rec.by_suffix(sources, "_valid"), "+").alias("attested"), F.array_join(rec.by_suffix(sources, "_unlikely"), "+").alias("unlikely"),
        F.round(r["advanced_validation"]["confidence"] * 100).cast("int").alias("confidence"), rec.status_code(r["status"]).alias("code"), r["category"].alias("category"), rec.clean(r["definition"]).alias("definition"),
    )


@on_records("d09_evidence", "select case when definition is not null and etymology is not null then 'definition+etymology' when definition is not null then 'definition' when etymology is not null then 'etymology' else 'none' end as evidence, count(*) as n from r group by 1")
def _(d, r):
    return d.groupBy(rec.evidence_of(r).alias("evidence")).agg(F.count("*").alias("n"))


_STAGE2 = """s as (select word, n_valid::int as n_valid_sources, case when n_valid >= 4 then '4+' else n_valid::varchar end as stratum, n_all > 0 and n_valid = 0 as all_unlikely,
    (n_docs % 2 = 1 or n_docs % 4 < 2) and (n_docs % 2 <> 1 or n_tokens % 2 = 0) and (n_docs % 4 >= 2 or n_tokens % 3 = 0) as pipeline_checks_passed
    from (select *, len(list_filter(candidate_source, lambda s: ends_with(s, '_valid'))) as n_valid, len(candidate_source) as n_all from r join named using (word)) where status = 'invalid')"""


@on_records("d10_stage2_frame", f", {_STAGE2} select * from s")
def _(d, r):
    return d.where(r["status"] == "invalid").select("word", *rec.stage2(r))


@on_records("d15_repaired_status", "select case when status = 'WordStatus.VALID' then 'valid' else status end as status, unverified_llm_verdict is not null as renamed, count(*) as n from r group by all")
def _(d, r):
    return d.groupBy(rec.repaired(r["status"]).alias("status"), r["unverified_llm_verdict"].isNotNull().alias("renamed")).agg(F.count("*").alias("n"))


@on_tables("j09_stage1_ledger", f"with {RECORDS_SQL}, {_LISTS} select word, source, case when definition is not null and etymology is not null then 'definition+etymology' when definition is not null then 'definition' when etymology is not null then 'etymology' else 'none' end as evidence, coalesce(source = 'merriam_webster_collegiate', false) as resolved from r semi join valid using (word) semi join invalid using (word)")
def _(spark, sf_dir):
    valid, invalid = _valid_invalid(words(spark, sf_dir))
    return rec.stage1(valid.intersect(invalid), rec.parse(records(spark, sf_dir)))


#: What three dictionaries say of a word, in their order, by its counts.
STATUSES = {
    "medical": "case n_tokens % 6 when 0 then 'valid' when 1 then 'error' when 2 then 'unconfigured' else 'not_found' end",
    "collegiate": "case n_docs % 7 when 0 then 'abbreviation' when 1 then 'error' when 2 then 'valid' when 3 then 'proper_noun' else 'not_found' end",
    "free": "case first_doc % 5 when 0 then 'valid' when 1 then 'error' else 'not_consulted' end",
}
_STATUSES = ", ".join(f"{sql} as {name}" for name, sql in STATUSES.items())
_RULES = "in ('valid', 'abbreviation', 'proper_noun')"
_OUTCOMES = f"""t as (select word, case when n_sources >= 4 then '4+' else n_sources::varchar end as stratum, {_STATUSES} from words),
u as (select *, case when medical {_RULES} then 'medical' when collegiate {_RULES} then 'collegiate' when free {_RULES} then 'free' end as deciding_source,
    case when medical {_RULES} then medical when collegiate {_RULES} then collegiate when free {_RULES} then free end as deciding_status from t),
o as (select *, case when deciding_status = 'valid' then 'refuted' when deciding_status is not null then 'corroborated'
    when 'not_found' in (medical, collegiate, free) then 'unadjudicated' else 'error' end as outcome from u)"""


def outcomes(w: DataFrame) -> DataFrame:
    """(word, stratum, deciding_source, deciding_status, outcome)."""
    own = w.select("word", F.when(F.col("n_sources") >= 4, "4+").otherwise(F.col("n_sources").cast("string")).alias("stratum"), *[F.expr(sql).alias(name) for name, sql in STATUSES.items()])
    every = F.array(*STATUSES)
    first = F.get(F.filter(F.array(*[F.when(F.col(c).isin("valid", "abbreviation", "proper_noun"), F.lit(c)) for c in STATUSES]), lambda x: x.isNotNull()), F.lit(0))
    ruled = rec.deciding(every)
    return own.select("word", "stratum", first.alias("deciding_source"), ruled.alias("deciding_status"), rec.outcome(ruled, every).alias("outcome"))


@on_tables("d12_outcomes", f"with {WORDS_SQL}, {_OUTCOMES} select word, stratum, deciding_source, deciding_status, outcome from o")
def _(spark, sf_dir):
    return outcomes(words(spark, sf_dir))


def tallied(o: DataFrame, dictionaries: tuple[str, ...] | None = None) -> DataFrame:
    """Outcomes of each stratum; with dictionaries, rulings of any other source count as unadjudicated."""
    kind = F.col("outcome")
    if dictionaries:
        kind = F.when(kind.isin("refuted", "corroborated") & ~F.col("deciding_source").isin(*dictionaries), "unadjudicated").otherwise(kind)
    return o.groupBy("stratum").agg(*[F.count_if(kind == k).alias(k) for k in ("refuted", "corroborated", "unadjudicated", "error")], F.count("*").alias("total"))


_TALLY = "select stratum, count(*) filter (k = 'refuted') as refuted, count(*) filter (k = 'corroborated') as corroborated, count(*) filter (k = 'unadjudicated') as unadjudicated, count(*) filter (k = 'error') as error, count(*) as total from"


@on_tables("f20_stratum_outcomes", f"with {WORDS_SQL}, {_OUTCOMES} {_TALLY} (select stratum, outcome as k from o) group by stratum")
def _(spark, sf_dir):
    return tallied(outcomes(words(spark, sf_dir)))


@on_tables("f21_mw_only", f"with {WORDS_SQL}, {_OUTCOMES} {_TALLY} (select stratum, case when outcome in ('refuted', 'corroborated') and deciding_source not in ('medical', 'collegiate') then 'unadjudicated' else outcome end as k from o) group by stratum")
def _(spark, sf_dir):
    return tallied(outcomes(words(spark, sf_dir)), ("medical", "collegiate"))


@on_tables("f39_coverage_gate", f"with {WORDS_SQL}, {_OUTCOMES} select stratum, round(count(*) filter (outcome = 'error') / count(*), 9) as absent, count(*) filter (outcome = 'error') / count(*) > 0.1 as stopped from o group by stratum")
def _(spark, sf_dir):
    absent = F.count_if(F.col("outcome") == "error") / F.count("*")
    return outcomes(words(spark, sf_dir)).groupBy("stratum").agg(F.round(absent, 9).alias("absent"), (absent > 0.1).alias("stopped"))


@on_tables("f24_weighted_totals", f"""with {WORDS_SQL}, {_OUTCOMES}, t2 as (select stratum, count(*) filter (outcome = 'refuted') as hits, count(*) filter (outcome in ('refuted', 'corroborated')) as ruled, count(*) as n from o group by stratum)
select coalesce(stratum, 'Total') as stratum, sum(hits)::bigint as hits, sum(ruled)::bigint as ruled, sum(n)::bigint as n, round(sum(ruled) / sum(n), 9) as coverage, round(sum(n * hits / ruled) / sum(n), 9) as weighted, (select min_by(stratum, ruled / n) from t2) as worst from t2 group by rollup (stratum)""")
def _(spark, sf_dir):
    kind = F.col("outcome")
    by = outcomes(words(spark, sf_dir)).groupBy("stratum").agg(F.count_if(kind == "refuted").alias("hits"), F.count_if(kind.isin("refuted", "corroborated")).alias("ruled"), F.count("*").alias("n"))
    worst = by.agg(F.min_by("stratum", F.col("ruled") / F.col("n")).alias("worst"))  # one row
    total = by.rollup("stratum").agg(F.sum("hits").alias("hits"), F.sum("ruled").alias("ruled"), F.sum("n").alias("total"), F.sum(F.col("n") * F.col("hits") / F.col("ruled")).alias("weight"))
    return total.join(F.broadcast(worst), F.lit(True)).select(F.coalesce("stratum", F.lit("Total")).alias("stratum"), "hits", "ruled", F.col("total").alias("n"), F.round(F.col("ruled") / F.col("total"), 9).alias("coverage"), F.round(F.col("weight") / F.col("total"), 9).alias("weighted"), "worst")


@on_tables("d11_pos_strata", f"with {WORDS_SQL} select word, case when n_docs % 4 = 0 then 'not-in-wn' when n_docs % 4 = 1 or n_tokens % 3 = 0 then 'wn-adj' else 'wn-other' end as stratum from words")
def _(spark, sf_dir):
    empty, a, n = F.array().cast("array<string>"), F.array(F.lit("a")), F.array(F.lit("n"), F.lit("v"))
    pos = F.when(F.col("n_docs") % 4 == 0, empty).when(F.col("n_docs") % 4 == 1, a).when(F.col("n_tokens") % 3 == 0, F.array(F.lit("s"), F.lit("n"))).otherwise(n)
    return words(spark, sf_dir).select("word", rec.pos_stratum(pos).alias("stratum"))


@on_tables("d13_inflections", f"""with {WORDS_SQL}, p as (select s.word as stem, s.n_docs, s.first_doc, f.word as form from words s join words f on f.word = s.word || 's' union all select s.word, s.n_docs, s.first_doc, f.word from words s join words f on f.word = s.word || 'es'), g as (select stem, n_docs, first_doc, list(form order by form) as forms from p where length(form) > 4 group by all)
select stem, array_to_string(forms, ' ') as forms, case when n_docs % 5 = 0 then case when first_doc % 3 = 0 then 'no-stems-array' when stem || 's' in forms then 'inflection-listed' else 'inflection-absent' end when n_docs % 5 = 1 then 'inflection-absent' when n_docs % 5 = 2 then 'mw-absent' else 'error' end as outcome,
array_to_string(case when n_docs % 5 = 0 and first_doc % 3 <> 0 then list_filter(forms, lambda f: f = stem || 's') else [] end, ' ') as listed,
array_to_string(case when n_docs % 5 = 0 then case when first_doc % 3 = 0 then forms else list_filter(forms, lambda f: f <> stem || 's') end when n_docs % 5 = 1 then forms else [] end, ' ') as missing from g""")
def _(spark, sf_dir):
    w = words(spark, sf_dir)
    n = F.length("word")
    cut = w.where(F.col("word").endswith("s") & (n > 4)).select(F.col("word").alias("form"), F.explode(F.array(F.left("word", n - 1), F.when(F.col("word").endswith("es"), F.left("word", n - 2)))).alias("word")).where("word is not null")
    forms = cut.groupBy("word").agg(F.sort_array(F.collect_list("form")).alias("forms"))  # two forms at most
    own = forms.join(w.select("word", "n_docs", "first_doc"), "word")
    status = F.when(F.col("n_docs") % 5 == 0, "valid").when(F.col("n_docs") % 5 == 1, "abbreviation")
    stems = F.when(F.col("first_doc") % 3 != 0, F.array(F.col("word"), F.initcap(F.concat("word", F.lit("s")))))
    said = F.array(F.when(F.col("n_docs") % 5 == 2, "not_found").otherwise("error"))
    kind, listed, missing = rec.inflections(status, F.col("forms"), stems, said)
    return own.select(F.col("word").alias("stem"), F.array_join("forms", " ").alias("forms"), kind, F.array_join(listed, " ").alias("listed"), F.array_join(missing, " ").alias("missing"))


@on_tables("d20_payload_verdicts", f"with {WORDS_SQL} select word, case when n_tokens % 6 = 0 then 'not_found' when n_tokens % 6 = 1 then 'not_found' when n_tokens % 6 = 2 then 'abbreviation' when n_tokens % 6 = 3 then 'proper_noun' else 'valid' end as verdict from words where length(word) > 1")
def _(spark, sf_dir):
    entry = lambda head, fl, stem, section: F.concat(F.lit('{"meta":{"id":"'), head, F.lit(':1","stems":["'), stem, F.lit(f'"],"section":"{section}"}},"hwi":{{"hw":"'), head, F.lit(f'"}},"fl":"{fl}","def":[{{"sseq":1}}]}}'))
    w, other = F.col("word"), F.concat("word", F.lit("xx"))
    kind = F.col("n_tokens") % 6
    listed = lambda *e: F.concat(F.lit("["), F.concat_ws(",", *e), F.lit("]"))
    payload = (
        F.when(kind == 0, F.lit("[]")).when(kind == 1, F.concat(F.lit('["'), other, F.lit('","b"]')))
        .when(kind == 2, listed(entry(other, "noun", other, "alpha"), entry(w, "abbreviation", w, "alpha")))
        .when(kind == 3, F.when(F.col("n_docs") % 2 == 0, listed(entry(F.initcap(w), "noun", w, "alpha"))).otherwise(listed(entry(w, "noun", w, "biog"))))
        .when(kind == 4, listed(entry(other, "noun", other, "alpha"), entry(F.concat(F.left(w, F.lit(1)), F.lit("*"), F.substr(w, F.lit(2))), "noun", other, "alpha")))
        .otherwise(listed(entry(other, "noun", F.upper(w), "alpha")))
    )
    return words(spark, sf_dir).where(F.length("word") > 1).select("word", rec.payload_verdict(w, payload).alias("verdict"))


@on_tables("e16_attestations", f"with {WORDS_SQL} select word, n || '/7 sources' as attested, array_to_string(names, ',') as names from (select w as word, count(*) as n, list(source order by source) as names from (select distinct w, source from tokens where {_ORDINAL} < 7) group by w)")
def _(spark, sf_dir):
    own = word_sources(spark, sf_dir).where(F.substring("source", 4, 9).cast("int") < 7)
    by = own.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("source")).alias("names"))  # seven at most
    return by.select("word", F.concat(F.col("n").cast("string"), F.lit("/7 sources")).alias("attested"), F.array_join("names", ",").alias("names"))


@on_tables("e20_screen_and_confirm", f"with {WORDS_SQL}, titles as (select distinct word from words where n_docs >= 2), english as (select word from words where n_docs >= 4 and n_sources >= 2) select intake, count(*) as n, count(*) filter (word in (select word from titles)) as screened, count(*) filter (word in (select word from titles) and word in (select word from english)) as confirmed from words group by intake")
def _(spark, sf_dir):
    w = words(spark, sf_dir)
    own, titles, english = w, w.where("n_docs >= 2").select("word"), w.where("n_docs >= 4 and n_sources >= 2").select("word")
    screened = own.join(titles, "word", "left_semi")
    confirmed = screened.join(english, "word", "left_semi")
    count = lambda df, name: df.groupBy("intake").agg(F.count("*").alias("k")).select("intake", F.lit(name).alias("kind"), "k")
    every = count(own, "n").unionByName(count(screened, "screened")).unionByName(count(confirmed, "confirmed"))
    return every.groupBy("intake").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("k"))), F.lit(0)).alias(c) for c in ("n", "screened", "confirmed")])


@on_tables("f07_growth", """with t as (select o_orderdate::date as day, count(*) as n from orders group by 1), c as (select day, sum(n) over (order by day)::bigint as total from t),
g as (select day, case when day(day) % 7 = 0 then 'not recorded' when day(day) % 11 = 0 then '' else total::varchar end as raw from c), p as (select day, try_cast(raw as bigint) as total from g where regexp_full_match(raw, '\\d+')), e as (select total - lag(total) over (order by day) as delta from p)
select (select min(day)::varchar from p) as recorded_from, (select max(day)::varchar from p) as recorded_to, (select count(*) from p) as days_recorded, (select count(*) from g) - (select count(*) from p) as days_unrecorded, (select min_by(total, day) from p) as first, (select max_by(total, day) from p) as last, (select count(*) from e where delta <> 0) as events""")
def _(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    total = stats.running(F.col("n"), F.col("day"))  # one row a day
    raw = F.when(F.dayofmonth("day") % 7 == 0, "not recorded").when(F.dayofmonth("day") % 11 == 0, "").otherwise(total.cast("string"))
    return stats.growth(days.select("day", raw.alias("raw")))


#: A dictionary's answer for a word as JSON text, for either engine.
_PAYLOAD = """'{"hwi":{"prs":[' || case when n_docs % 3 = 0 then '{"mw":"' || word || '-mw"}' else '' end || ']},"et":' || case when n_docs % 4 = 0 then '[["snip","x"],["text","from {it}' || word || '{/it}"]]' else '[]' end || ',"def":[{"sseq":[[["sense",{"dt":[["vis",[]],["text","{bc}a {sx|' || word || '||} thing "]]}]]]}]}'"""


@on_tables(
    "d19_payload_paths",
    f"with {WORDS_SQL} select word, case when n_tokens % 5 <> 0 then 'a ' || word || ' thing' end as definition, case when n_tokens % 5 <> 0 and n_docs % 4 = 0 then 'from {{it}}' || word || '{{/it}}' end as etymology, case when n_tokens % 5 <> 0 and n_docs % 3 = 0 then word || '-mw' end as pronunciation from words",
)
def _(spark, sf_dir):
    payload = F.when(F.col("n_tokens") % 5 == 0, '{"def":[{"sseq":[]}],"et":"odd","hwi":[]}').otherwise(F.expr(_PAYLOAD))
    return words(spark, sf_dir).select("word", payload.alias("e")).select("word", rec.definition_of(F.col("e")).alias("definition"), rec.etymology_of(F.col("e")).alias("etymology"), rec.pronunciation_of(F.col("e")).alias("pronunciation"))


@on_tables("d17_word_entries", f"with {RECORDS_SQL} select word, nullif(trim(definition), '') as definition from r")
def _(spark, sf_dir):
    entry = rec.with_definition(F.col("word"), F.get_json_object("rec", "$.definition"))
    return records(spark, sf_dir).select(entry.alias("e")).select("e.word", "e.definition")


@on_tables(
    "j04_promoted_dictionary",
    f"with {RECORDS_SQL}, {_LISTS} select word, case when v.known then source else 'phase3_update' end as source, case when v.known then added_date else '2026-01-01' end as added_date, case when v.known then status else 'valid' end as validation_status from r left join (select word, true as known from valid) v using (word) where v.known or n_tokens >= 5",
)
def _(spark, sf_dir):
    valid, _ = _valid_invalid(words(spark, sf_dir))
    every = records(spark, sf_dir).select("word", *[F.get_json_object("rec", f"$.{a}").alias(b) for a, b in (("source", "source"), ("added_date", "added_date"), ("status", "validation_status"))])
    bare = words(spark, sf_dir).where("n_tokens >= 5").select(F.concat(F.lit(" "), F.upper("word")).alias("word"), *[F.lit(None).cast("string").alias(c) for c in ("source", "added_date", "validation_status")])
    once = lists.promoted_dictionary(every.join(valid, "word", "left_semi"), bare, "2026-01-01")
    return lists.promoted_dictionary(once, bare, "2027-01-01")  # again: nothing changes
