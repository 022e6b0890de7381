"""Registered queries over word features: scanning confusions, affixes, stems, frequency laws, priorities, samples and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import forms
from ..functions import words as fn
from ..operators import lists, models, stats
from ..operators.search import lookup
from ..sources.lexicon import WORDS_SQL, table, word_sources, words
from ..streaming import refused, replay
from .queries import _LISTS, _ORDINAL, _PATTERN, _valid_invalid, evidence, on_tables, on_words

#: Words attested well enough to be a stem or a source.
ATTESTED = "n_docs >= 3"
_values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
_one_of = lambda names: "[" + ", ".join(f"'{x}'" for x in names) + "]"

_NEIGHBOURS = f"""near as (select distinct w.word, w.n_tokens, s.word as neighbour, s.n_tokens as m from (select word, n_tokens, src, art, unnest(generate_series(1, length(word))) as i from words, (values {_values(forms.CONFUSIONS)}) as p(src, art)) w
join words s on substr(w.word, i, length(art)) = art and s.word = left(w.word, i - 1) || src || substr(w.word, i + length(art)) where s.{ATTESTED} and s.word <> w.word)"""


def _misread(w: DataFrame) -> DataFrame:
    """(word, neighbour, m): what a scan may have made of attested words, and their counts; only those are spelt out, not what every word may come from."""
    return w.where(ATTESTED).select(F.explode(forms.scanned_forms(F.col("word"))).alias("word"), F.col("word").alias("neighbour"), F.col("n_tokens").alias("m"))


def neighbours(w: DataFrame) -> DataFrame:
    """(word, n_tokens, neighbour, m): attested words that a scan may have turned into the word, and their counts."""
    return _misread(w).join(w.select("word", "n_tokens"), "word").select("word", "n_tokens", "neighbour", "m")


def most_frequent_neighbour(w: DataFrame) -> DataFrame:
    """(word, m): the largest count of a word's neighbours, of forms that need not be words; added up before it is shuffled."""
    return _misread(w).groupBy("word").agg(F.max("m").alias("m"))


@on_words("e08_scan_neighbours", f", {_NEIGHBOURS} select word, neighbour from near")
def _(w):
    return neighbours(w).select("word", "neighbour")


@on_words("l06_scan_feature", f", {_NEIGHBOURS} select word, least(127, count(*))::int as hits, round(max(log10((m + 1) / (n_tokens + 1))), 9) as best from near group by word")
def _(w):
    return neighbours(w).groupBy("word").agg(F.least(F.lit(127), F.count("*")).cast("int").alias("hits"), F.round(F.max(F.log10((F.col("m") + 1) / (F.col("n_tokens") + 1))), 9).alias("best"))


_UNIT = "('0x' || substr(sha256('{0}:' || word), 1, 16))::ubigint::double / 18446744073709551616.0"
_SITES = ", ".join(f"list_transform(list_filter(range(1, length(word) + 1), lambda i: substr(word, i, {len(a)}) = '{a}'), lambda i: left(word, i - 1) || '{b}' || substr(word, i + {len(a)}))" for a, b in forms.CONFUSIONS)


@on_words("l23_misread_controls", f", s as (select word, flatten([{_SITES}]) as sites, {_UNIT.format('ocr-site')} as unit from words where {ATTESTED}) select distinct sites[floor(unit * len(sites))::bigint % len(sites) + 1] as control from s where len(sites) > 0 and not exists (select 1 from words w where w.word = sites[floor(unit * len(sites))::bigint % len(sites) + 1])")
def _(w):
    made = w.where(ATTESTED).select(forms.misread(F.col("word"), fn.unit_hash(F.concat(F.lit("ocr-site:"), "word"))).alias("word"))
    return made.where("word is not null").distinct().join(w.select("word"), "word", "left_anti").select(F.col("word").alias("control"))


_VARIANTS = "(0, b), (1, b || 'e'), (2, case when length(b) >= 2 and b[-1] = b[-2] then b[:-2] end), (3, case when b[-1] = 'i' then b[:-2] || 'y' end)"
_PARSES = f"""suffixed as (select word, n_tokens, n_docs, 'suffix' as kind, affix, stem from (select w.*, a.affix, v.stem, row_number() over (partition by w.word order by length(a.affix) desc, v.j) as r
    from words w join (select unnest({_one_of(forms.SUFFIXES)}) as affix) a on ends_with(w.word, a.affix) and length(w.word) - length(a.affix) >= 3,
    lateral (select left(w.word, length(w.word) - length(a.affix)) as b) x, lateral (select unnest([0, 1, 2, 3]) as j, unnest([b, b || 'e', case when length(b) >= 2 and b[-1] = b[-2] then left(b, length(b) - 1) end, case when b[-1] = 'i' then left(b, length(b) - 1) || 'y' end]) as stem) v
    join words s on s.word = v.stem and s.{ATTESTED}) where r = 1),
prefixed as (select word, n_tokens, n_docs, 'prefix' as kind, affix, stem from (select w.*, a.affix, s.word as stem, row_number() over (partition by w.word order by length(a.affix) desc) as r
    from words w join (select unnest({_one_of(forms.PREFIXES)}) as affix) a on starts_with(w.word, a.affix) and length(w.word) - length(a.affix) >= 3 join words s on s.word = substr(w.word, length(a.affix) + 1) and s.{ATTESTED}) where r = 1),
affixes as (select 'suffix' as kind, unnest({_one_of(forms.SUFFIXES)}) as affix union all select 'prefix', unnest({_one_of(forms.PREFIXES)})),
found as (select * from suffixed union all select * from prefixed),
productivity as (select a.kind, a.affix, count(f.word) as types, coalesce(sum(f.n_tokens), 0)::bigint as tokens, count(*) filter (f.n_docs = 1) as once, min(f.n_tokens) as least, round(count(f.word) / sum(f.n_tokens), 9) as realised from affixes a left join found f on f.kind = a.kind and f.affix = a.affix group by all)"""


def parsed(w: DataFrame) -> DataFrame:
    """(word, n_tokens, n_docs, kind, affix, stem): a word's longest suffix and prefix that leave an attested stem."""
    word, stems, out = F.col("word"), w.where(ATTESTED).select(F.col("word").alias("stem")), []
    for kind, candidates in (("suffix", forms.suffix_parses), ("prefix", forms.prefix_parses)):
        each = w.select("word", "n_tokens", "n_docs", F.explode(candidates(word)).alias("c")).select("word", "n_tokens", "n_docs", "c.*").join(stems, "stem")
        best = each.groupBy("word", "n_tokens", "n_docs").agg(F.min(F.struct("place", "affix", "stem")).alias("b"))
        out.append(best.select("word", "n_tokens", "n_docs", F.lit(kind).alias("kind"), "b.affix", "b.stem"))
    return out[0].unionByName(out[1])


def productivity(w: DataFrame) -> DataFrame:
    """Types, tokens, one-document types and least count of every affix; those without a word stay, with zeros."""
    names = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(a).alias("affix")) for k, own in (("suffix", forms.SUFFIXES), ("prefix", forms.PREFIXES)) for a in own])
    every = w.sparkSession.range(1).select(F.explode(names).alias("a")).select("a.*")
    by = parsed(w).groupBy("kind", "affix").agg(F.count("*").alias("types"), F.sum("n_tokens").alias("tokens"), F.count_if(F.col("n_docs") == 1).alias("once"), F.min("n_tokens").alias("least"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return every.join(by, ["kind", "affix"], "left").select("kind", "affix", zero("types"), zero("tokens"), zero("once"), "least", F.round(F.col("types") / F.col("tokens"), 9).alias("realised"))


@on_words("e09_affix_parses", f", {_PARSES} select word, kind, affix, stem from found")
def _(w):
    return parsed(w).select("word", "kind", "affix", "stem")


@on_words("f15_affix_table", f", {_PARSES} select * from productivity")
def _(w):
    return productivity(w)


@on_words("l07_productivity", f", {_PARSES} select s.word, s.affix, p.realised from suffixed s join productivity p on p.kind = 'suffix' and p.affix = s.affix")
def _(w):
    own = parsed(w).where("kind = 'suffix'").select("word", "affix")
    return own.join(F.broadcast(productivity(w).where("kind = 'suffix'").select("affix", "realised")), "affix").select("word", "affix", "realised")  # a row an affix


def _rule_sql(rules) -> str:
    each = []
    for i, (suffix, *stratum, extras) in enumerate(rules):
        base = f"left(word, length(word) - {len(suffix)})"
        stems = [f"{base} || '{x}'" for x in extras] + [f"case when length({base}) >= 4 and {base}[-1] = {base}[-2] and {base}[-1] not in ('a', 'e', 'i', 'o', 'u') then left(word, length(word) - {len(suffix) + 1}) end", f"case when {base}[-1] = 'i' then left(word, length(word) - {len(suffix) + 1}) || 'y' end"]
        each += [f"select word, {i * 8 + j} as place, '{stratum[0] if stratum else ''}' as stratum, {s} as stem from base where ends_with(word, '{suffix}') and length(word) - {len(suffix)} >= 3" for j, s in enumerate(stems)]
    return " union all ".join(each)


@on_words("e06_first_stem", f", base as (select word from words), c as ({_rule_sql(forms.COMPARATIVES)}) select c.word as form, min_by(c.stem, c.place) as stem from c join words s on s.word = c.stem group by c.word")
def _(w):
    each = w.select(F.col("word").alias("form"), F.posexplode(forms.comparative_stems(F.col("word"))).alias("place", "stem"))
    return each.join(w.select(F.col("word").alias("stem")), "stem").groupBy("form").agg(F.min_by("stem", "place").alias("stem"))


@on_words("e07_inflection_groups", f", base as (select word from words where intake in ('synthetic', 'other')), c as ({_rule_sql(forms.INFLECTIONS)}), b as (select c.word, min_by(c.stratum, c.place) as stratum, min_by(c.stem, c.place) as stem from c join words s on s.word = c.stem group by c.word) select stem, stratum, string_agg(word, ' ' order by word) as forms, count(*) as n from b group by all")
def _(w):
    each = w.where("intake in ('synthetic', 'other')").select("word", F.explode(forms.inflection_stems(F.col("word"))).alias("c")).select("word", "c.*")
    best = each.join(w.select(F.col("word").alias("stem")), "stem").groupBy("word").agg(F.min(F.struct("place", "stratum", "stem")).alias("b"))
    return best.groupBy("b.stem", "b.stratum").agg(F.array_join(F.sort_array(F.collect_list("word")), " ").alias("forms"), F.count("*").alias("n"))


_BETAS = "[" + ", ".join(f"{b}::double" for b in models.BETAS) + "]"
_LAW = f"""c as (select n_tokens, count(*) as k from words group by 1), r as (select n_tokens, coalesce(sum(k) over (order by n_tokens desc rows between unbounded preceding and 1 preceding), 0) as above, k from c), t as (select sum(k) as size from c),
probe as (select distinct floor(pow(size, i / 399.0))::bigint as rank from t, (select unnest(generate_series(0, 399)) as i)), q as (select rank, log10(n_tokens) as y from probe join r on rank > above and rank <= above + k),
e as (select y, beta, log10(rank + beta) as x from q, (select unnest({_BETAS}) as beta)),
law as (select beta, -regr_slope(y, x) as alpha, regr_intercept(y, x) as log_c, regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x) as sse from e group by beta)"""


@on_words("f33_rank_law", f", {_LAW} select beta, round(alpha, 6) as alpha, round(log_c, 6) as log_c, round(sse, 6) as sse from law")
def _(w):
    return models.rank_law(w).select("beta", *[F.round(c, 6).alias(c) for c in ("alpha", "log_c", "sse")])


@on_words("l09_rank_residual", f", {_LAW}, best as (select * from law order by sse, beta limit 1) select word, round(log10(above + 1), 6) as zipf_rank, round(log10(n_tokens) - (log_c - alpha * log10(above + 1 + beta)), 6) as residual from words join r using (n_tokens), best")
def _(w):
    best = models.rank_law(w).orderBy("sse", "beta").limit(1)  # one row
    rank = F.col("rank")
    residual = F.log10("n_tokens") - (F.col("log_c") - F.col("alpha") * F.log10(rank + F.col("beta")))
    return w.join(models.ranks(w).select("n_tokens", "rank"), "n_tokens").join(F.broadcast(best), F.lit(True)).select("word", F.round(F.log10(rank), 6).alias("zipf_rank"), F.round(residual, 6).alias("residual"))


_LETTERS3 = "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyz")
_RE2 = "|".join([_LETTERS3, "q([^u]|$)", *(f"(?:{p})" for p in forms.UNLIKELY if "\\1" not in p and "(?!" not in p)])
_VOWELS = "length(regexp_replace(word, '[^aeiou]', '', 'g'))"
_COMPOUND = f"len(list_filter({_one_of(forms.PRODUCTIVE)}, lambda p: starts_with(word, p) and length(word) > length(p) + 3)) > 0"
_LIKELY = f"(length(word) between 3 and 15 and not regexp_matches(word, '{_RE2}') and {_VOWELS} / length(word) between 0.15 and 0.6 and not {_COMPOUND})"
_SCORE = f"""least(100, greatest(0, 50 + case when length(word) between 3 and 5 then 25 when length(word) between 6 and 8 then 15 when length(word) between 9 and 12 then 5 when length(word) = 2 then 10 when length(word) between 13 and 16 then -10 else -30 end
+ case when {_COMPOUND} then -35 else 0 end + case when length(word) <= 10 and len(list_filter({_one_of(forms.REAL_PREFIXES)}, lambda p: starts_with(word, p) and length(word) > length(p) + 2)) > 0 then 5 else 0 end
+ case when length(word) <= 10 and len(list_filter({_one_of(forms.COMMON_SUFFIXES)}, lambda s: ends_with(word, s) and length(word) > length(s) + 2)) > 0 then 5 else 0 end
+ case when {_VOWELS} / length(word) between 0.25 and 0.5 then 10 else -10 end + case when contains('{forms.COMMON_FIRST}', word[1]) then 5 else 0 end + case when len(list_distinct(string_split(word, ''))) >= length(word) * 0.6 then 5 else 0 end))::int"""


@on_words("c19_likely_english", f"select intake, count(*) as n, count(*) filter ({_LIKELY}) as likely from words group by intake")
def _(w):
    return w.groupBy("intake").agg(F.count("*").alias("n"), F.count_if(forms.likely_english(F.col("word"))).alias("likely"))


@on_words("d21_priority", f"select word, {_LIKELY} as likely, {_SCORE} as score from words")
def _(w):
    return w.select("word", forms.likely_english(F.col("word")).alias("likely"), forms.priority(F.col("word")).alias("score"))


@on_words("d22_priority_tiers", f"select ({_SCORE} // 5 * 5)::int as tier, count(*) as n from words group by 1")
def _(w):
    return w.groupBy((F.floor(forms.priority(F.col("word")) / 5) * 5).cast("int").alias("tier")).agg(F.count("*").alias("n"))


@on_words("g07_tier_fill", f"select word, score from (select word, {_SCORE} as score from words where {_LIKELY}) order by score // 5 desc, sha256('tier:' || word) limit 500")
def _(w):
    """The best tiers first, in a random order that stays the same within a tier."""
    scored = w.where(forms.likely_english(F.col("word"))).select("word", forms.priority(F.col("word")).alias("score"))
    return scored.orderBy(F.desc(F.floor(F.col("score") / 5)), F.sha2(F.concat(F.lit("tier:"), "word"), 256)).limit(500)


@on_words("g03_global_sample", "select word, substr(sha256('practice:' || word), 1, 16) as rank_key from words order by sha256('practice:' || word), word limit 50")
def _(w):
    key = F.sha2(F.concat(F.lit("practice:"), "word"), 256)
    return w.orderBy(key, "word").limit(50).select("word", F.substring(key, 1, 16).alias("rank_key"))


@on_words("g15_row_index", "select word, row_number() over (order by word) - 1 as index from words")
def _(w):
    return stats.row_index(w.select("word"), "word")


@on_words("h04_stride_sample", "select word from (select word, row_number() over (order by word) - 1 as i, count(*) over () as n from words) where i % greatest(1, n // 100) = 0 order by i limit 100")
def _(w):
    step = max(1, w.count() // 100)
    return stats.row_index(w.select("word"), "word").where(F.col("index") % step == 0).orderBy("index").limit(100).select("word")


@on_words("h08_target_sizes", "select length, n, case when n < 1000 then n else least(n, greatest(2000, least(8000, floor(22 * sqrt(n))::bigint))) end as target from (select length(word)::int as length, count(*) as n from words where length(word) between 2 and 35 group by 1)")
def _(w):
    n = F.col("n")
    by = w.where(F.col("word").rlike(r"^[a-z]{2,35}\z")).groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    return by.select("length", "n", F.when(n < 1000, n).otherwise(F.least(n, F.greatest(F.lit(2000), F.least(F.lit(8000), F.floor(22 * F.sqrt(n)))))).alias("target"))


@on_words("f06_bulk_dates", ", c as (select added, count(*) as n from words group by added), b as (select n from c order by n desc, added limit 3) select (select sum(n) from b)::bigint as bulk, (select sum(n) from c)::bigint - (select sum(n) from b)::bigint as singly, (select count(*) from c) as dates")
def _(w):
    by = w.groupBy("added").agg(F.count("*").alias("n"))
    bulk = by.orderBy(F.desc("n"), "added").limit(3).agg(F.sum("n").alias("bulk"))
    return by.agg(F.sum("n").alias("total"), F.count("*").alias("dates")).join(F.broadcast(bulk), F.lit(True)).select("bulk", (F.col("total") - F.col("bulk")).alias("singly"), "dates")


@on_words("f29_auc_interval", """, s as (select intake, (length(word) > 7)::int as y, rank() over (partition by intake order by n_tokens) + (count(*) over (partition by intake, n_tokens) - 1) / 2 as r from words),
a as (select intake, sum(y)::double as p, sum(1 - y)::double as q, (sum(r * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) as auc from s group by intake having least(sum(y), sum(1 - y)) >= 10),
e as (select *, sqrt(greatest((auc * (1 - auc) + (p - 1) * (auc / (2 - auc) - auc * auc) + (q - 1) * (2 * auc * auc / (1 + auc) - auc * auc)) / (p * q), 1e-12)) as se from a)
select intake, round(auc, 9) as auc, round(auc - 1.96 * se, 9) as low, round(auc + 1.96 * se, 9) as high, round(1 - auc, 9) as flipped from e""")
def _(w):
    found = stats.auc(w.select("intake", (F.length("word") > 7).alias("label"), F.col("n_tokens").alias("score")), ["intake"]).where("auc is not null")
    low, high = stats.auc_interval(F.col("auc"), F.col("positives"), F.col("negatives"))
    return found.select("intake", F.round("auc", 9).alias("auc"), F.round(low, 9).alias("low"), F.round(high, 9).alias("high"), F.round(1 - F.col("auc"), 9).alias("flipped"))


_SCORES = "s as (select word, n_docs / (n_docs + n_tokens) as p from words)"


@on_words("f26_deciles", f", {_SCORES}, e as (select quantile_cont(p, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as edges from s) select i::int as bin, round(edges[i], 9) as low, round(edges[i + 1], 9) as high, (select count(*) from s where p >= edges[i] and (p < edges[i + 1] or (i = 10 and p = edges[i + 1]))) as n from e, (select unnest(generate_series(1, 10)) as i)")
def _(w):
    return stats.deciles(w.select((F.col("n_docs") / (F.col("n_docs") + F.col("n_tokens"))).alias("p")), "p")


@on_words("f25_strata", f", {_SCORES}, t as (select 'all' as stratum, p from s union all select 'long', p from s where length(word) >= 8 union all select 'rare', p from s join words using (word) where n_docs = 1) select stratum, count(*) as n, round(avg(p), 9) as mean, round(count(*) filter (p > 0.5) / count(*), 9) as above_half, round(sum(p), 6) as total from t group by stratum")
def _(w):
    p = F.col("n_docs") / (F.col("n_docs") + F.col("n_tokens"))
    own = F.array(F.lit("all"), F.when(F.length("word") >= 8, "long"), F.when(F.col("n_docs") == 1, "rare"))
    each = w.select(p.alias("p"), F.explode(own).alias("stratum")).where("stratum is not null")
    return each.groupBy("stratum").agg(F.count("*").alias("n"), F.round(F.avg("p"), 9).alias("mean"), F.round(F.count_if(F.col("p") > 0.5) / F.count("*"), 9).alias("above_half"), F.round(F.sum("p"), 6).alias("total"))


@on_tables("f28_disagreement", f"with {WORDS_SQL}, {_PATTERN} select pattern, count(*) as n, count(*) filter (listed <> likely) as differ from (select e.pattern, bit_count(pattern) >= 4 as likely, n_docs >= 4 as listed from evidence e join words using (word)) group by pattern having count(*) filter (listed <> likely) > 0 order by differ desc, pattern limit 15")
def _(spark, sf_dir):
    both = evidence(spark, sf_dir).join(words(spark, sf_dir).select("word", (F.col("n_docs") >= 4).alias("listed")), "word")
    by = both.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if(F.col("listed") != (F.bit_count("pattern") >= 4)).alias("differ"))
    return by.where("differ > 0").orderBy(F.desc("differ"), "pattern").limit(15)


@on_tables("c29_no_evidence", f"with {WORDS_SQL}, {_PATTERN} select pattern = 0 as unseen, n_docs = 1 as single, count(*) as n from evidence join words using (word) group by all")
def _(spark, sf_dir):
    both = evidence(spark, sf_dir).join(words(spark, sf_dir).select("word", "n_docs"), "word")
    return both.groupBy((F.col("pattern") == 0).alias("unseen"), (F.col("n_docs") == 1).alias("single")).agg(F.count("*").alias("n"))


@on_tables("f16_smallest_tier", f"with {WORDS_SQL} select w as word, min(10 + {_ORDINAL} % 10 * 10)::int as tier from tokens group by w")
def _(spark, sf_dir):
    tier = 10 + F.substring("source", 4, 9).cast("int") % 10 * 10
    return word_sources(spark, sf_dir).groupBy(F.col("w").alias("word")).agg(F.min(tier).cast("int").alias("tier"))


@on_words("f34_distinct_counts", "select count(distinct intake) as intakes, count(distinct added) as dates, count(distinct length(word)) as lengths, count(distinct n_docs) as doc_counts from words")
def _(w):
    return w.agg(*[F.count_distinct(c).alias(n) for n, c in (("intakes", F.col("intake")), ("dates", F.col("added")), ("lengths", F.length("word")), ("doc_counts", F.col("n_docs")))])


@on_words("l08_dispersion_proxies", "select word, round(n_tokens / n_docs, 9) as tokens_per_volume, round(n_docs / n_sources, 9) as volumes_per_year, round(log10(n_tokens), 9) as log_match, round(log10(n_docs), 9) as log_volume, n_sources as years, round(n_sources / 20, 9) as span_fill from words")
def _(w):
    share = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 9)
    return w.select("word", share("n_tokens", "n_docs").alias("tokens_per_volume"), share("n_docs", "n_sources").alias("volumes_per_year"), F.round(F.log10("n_tokens"), 9).alias("log_match"), F.round(F.log10("n_docs"), 9).alias("log_volume"), F.col("n_sources").alias("years"), F.round(F.col("n_sources") / 20, 9).alias("span_fill"))


@on_words("i04_disjointness", f", {_LISTS} select (select count(*) from (select word from valid intersect select word from invalid)) as on_both, (select count(*) from (select word from words where intake = 'twl' except select word from valid)) as twl_outside, (select count(*) from valid) as valid, (select count(*) from invalid) as invalid")
def _(w):
    valid, invalid = (F.col("n_sources") >= 2), (F.col("n_sources") < 2) | (F.col("first_doc") % 50 == 0)
    return w.agg(F.count_if(valid & invalid).alias("on_both"), F.count_if((F.col("intake") == "twl") & ~valid).alias("twl_outside"), F.count_if(valid).alias("valid"), F.count_if(invalid).alias("invalid"))


@on_tables("c17_new_words", f"with {WORDS_SQL}, {_LISTS}, found as (select distinct lower(trim(t)) as word from (select unnest(string_split(text, ' ')) as t from documents)) select word from found anti join valid using (word) where regexp_full_match(word, '[a-z]{{2,45}}')")
def _(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("t")).select(F.lower(F.trim("t")).alias("word")).distinct()
    return found.where(fn.form_reason(F.col("word"), 2, 45).isNull()).join(_valid_invalid(words(spark, sf_dir))[0], "word", "left_anti")


@on_tables("c13_validation_split", "select reason is null as valid, reason, count(*) as n from (select case when t = '' then 'empty' when t <> lower(t) then 'uppercase' when not regexp_full_match(t, '[a-z]+') then 'non-alphabetic' when length(t) > 100 then 'too long' end as reason from (select distinct unnest(string_split(text, ' ')) as t from documents)) group by all")
def _(spark, sf_dir):
    each = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    reason = fn.form_reason(F.col("word"), None, 100)
    return each.groupBy(reason.isNull().alias("valid"), reason.alias("reason")).agg(F.count("*").alias("n"))


#: The day from which cooldowns count; a parameter, so that results stay the same.
AS_OF = "2026-02-15"
_CHECKED = "case when first_doc % 3 <> 0 then added end"


@on_words("g14_rotation", f"select word, checked::varchar as checked from (select word, {_CHECKED} as checked from words where n_sources < 2) where checked is null or checked <= date '{AS_OF}' - 40 order by coalesce(checked::varchar, ''), word limit 200")
def _(w):
    checked = w.where("n_sources < 2").select("word", F.expr(_CHECKED).alias("checked"))
    return lists.due(checked, AS_OF, days=40, limit=200).select("word", F.col("checked").cast("string").alias("checked"))


@on_words("j10_progress_eviction", f"select count(*) as before, count(*) filter (checked > date '{AS_OF}' - 40) as kept from (select {_CHECKED} as checked from words) where checked is not null")
def _(w):
    before = w.select("word", F.expr(_CHECKED).alias("checked")).where("checked is not null")
    kept = lists.evict(before, AS_OF, days=40)
    size = lambda df, name: df.agg(F.count("*").alias(name))
    return size(before, "before").join(F.broadcast(size(kept, "kept")), F.lit(True))  # one row each


_LEDGER = f"""frame as (select word from words where n_sources >= 2), raw as (select distinct lower(t) as t from (select unnest(string_split(text, ' ')) as t from documents)), bad as (select t as word, translate(regexp_replace(t, '[^a-zñéáíóú]', '', 'g'), 'ñéáíóú', 'neaiou') as plain from raw where t <> '' and not regexp_full_match(t, '[a-z]+')),
d as (select word, 'delete_malformed' as action, case when starts_with(word, '-') or ends_with(word, '-') then 'fragment' when strlen(word) <> length(word) then 'accented' else 'compound' end as category, exists (select 1 from frame f where f.word = plain) as listed, plain from bad)"""


@on_tables("j08_form_ledger", f"with {WORDS_SQL}, {_LEDGER} select word, action, category, listed from d union all select distinct plain, 'add_candidate', 'plain-form', false from d where not listed and regexp_full_match(plain, '[a-z]+')")
def _(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("t")).select(F.lower("t").alias("word")).distinct().where("word <> ''")
    return lists.form_ledger(raw, words(spark, sf_dir).where("n_sources >= 2").select("word"))


@on_tables("j07_form_ledger_problems", f"with {WORDS_SQL}, frame as (select word from words where n_sources >= 2), l as (select word, case when n_docs % 3 = 0 then 'delete_malformed' when n_docs % 3 = 1 then 'add_candidate' else 'rename' end as action from words) select word, case when action = 'delete_malformed' then 'well-formed' when action = 'add_candidate' then 'already present' else 'unknown action' end as problem from l left join (select word as known from frame) f on known = word where action <> 'add_candidate' or known is not null")
def _(spark, sf_dir):
    w = words(spark, sf_dir)
    action = F.when(F.col("n_docs") % 3 == 0, "delete_malformed").when(F.col("n_docs") % 3 == 1, "add_candidate").otherwise("rename")
    return lists.form_problems(w.select("word", action.alias("action")), w.where("n_sources >= 2").select("word"))


#: The events table as an adjudication log: each user an item, errors verdicts, signups amendments, the rest searches.
_LOG = "select event_id as seq, user_id as item_id, case event_type when 'error' then 'verdict' when 'signup' then 'verdict_amend' else 'search' end as event, event_type as instrument, case when value > 100 then 'word' else 'not' end as verdict from events where user_id is not null"


def log_of(spark, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "verdict").when(F.col("event_type") == "signup", "verdict_amend").otherwise("search")
    return table(spark, sf_dir, "events").where("user_id is not null").select(F.col("event_id").alias("seq"), F.col("user_id").alias("item_id"), kind.alias("event"), F.col("event_type").alias("instrument"), F.when(F.col("value") > 100, "word").otherwise("not").alias("verdict"))


@on_tables("m01_replay", f"with l as ({_LOG}) select item_id, arg_max(verdict, seq) filter (event <> 'search') as verdict, count(*) filter (event = 'verdict_amend') as amended, coalesce(string_agg(instrument, ',' order by seq) filter (event = 'search'), '') as searches from l group by item_id")
def _(spark, sf_dir):
    return replay(log_of(spark, sf_dir)).withColumn("searches", F.array_join("searches", ","))


@on_tables("m02_refused_events", f"with l as ({_LOG}), f as (select item_id, min(seq) as first from l where event = 'verdict' group by item_id) select item_id, seq, event from l left join f using (item_id) where (event = 'verdict' and seq > first) or (event = 'verdict_amend' and (first is null or seq < first))")
def _(spark, sf_dir):
    return refused(log_of(spark, sf_dir))


@on_words("e11_lookup", "select word, n_tokens, intake, added::varchar as added from words where word = 'the'")
def _(w):
    return lookup(w, " The ").select("word", "n_tokens", "intake", F.col("added").cast("string"))


@on_words("e12_shard_lookup", "select word, h % 512 as shard, n_docs from (select word, n_docs, list_reduce(list_prepend(2166136261::bigint, list_transform(string_split(word, ''), lambda c: ascii(c)::bigint)), lambda h, c: (xor(h, c) * 16777619) & 4294967295) as h from words) where h % 512 = 88")
def _(w):
    """The words of one shard, as a reader of its file gets them."""
    return w.withColumn("shard", fn.fnv1a(F.col("word")) % 512).where("shard = 88").select("word", "shard", "n_docs")


@on_words("e13_prefix_range", "select word, n_docs from words where word >= 'th' and word < 'ti'")
def _(w):
    return w.where((F.col("word") >= "th") & (F.col("word") < "ti")).select("word", "n_docs")


@on_words("b12_download_lists", "select 'human' as list, count(*) as n, sum(strlen(word) + 1)::bigint as bytes from words where intake <> 'synthetic' and strlen(word) between 2 and 45 union all select 'tournament', count(*), sum(strlen(word) + 1)::bigint from words where intake = 'twl' and strlen(word) between 2 and 45")
def _(w):
    own = F.array(F.when(F.col("intake") != "synthetic", "human"), F.when(F.col("intake") == "twl", "tournament"))
    each = w.where(F.octet_length("word").between(2, 45)).select("word", F.explode(own).alias("list")).where("list is not null")
    return each.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.octet_length("word") + 1).alias("bytes"))


@on_words("d02_first_dates", "select added::varchar as added, count(*) as n, dense_rank() over (order by added) as code from words group by added")
def _(w):
    """Dates as codes in their order; there are as many rows as dates."""
    by = w.groupBy("added").agg(F.count("*").alias("n"))
    return by.select(F.col("added").cast("string").alias("added"), "n", F.dense_rank().over(Window.orderBy("added")).cast("long").alias("code"))


@on_words("o09_tripwires", "select 'intake twl share' as metric, count(*) filter (intake = 'twl') / count(*) > 0.5 as tripped from words union all select 'words without a date', count(*) filter (added is null) > 0 from words union all select 'distinct dates', count(distinct added) not between 1 and 365 from words union all select 'longest word', max(length(word)) > 100 from words")
def _(w):
    share = F.count_if(F.col("intake") == "twl") / F.count("*")
    found = w.agg(share.alias("share"), F.count_if(F.col("added").isNull()).alias("undated"), F.count_distinct("added").alias("dates"), F.max(F.length("word")).alias("longest"))
    return stats.tripwires(found, {"intake twl share": ("share", None, 0.5), "words without a date": ("undated", None, 0), "distinct dates": ("dates", 1, 365), "longest word": ("longest", None, 100)}).select("metric", "tripped")
