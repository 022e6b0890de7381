"""Registered queries over fitted models, control words and quality scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import words as fn
from ..operators import models
from ..sources.lexicon import WORDS_SQL, table, tokens, words
from . import records  # noqa: F401  # its SQL is used here
from .queries import _PATTERN, ORACLE_SQL, QUERIES, evidence, on_tables, on_words

#: Weights of the uniform model and of orders 1 to 4, fixed so that SQL can repeat the scores; l03_char_weights fits them.
WEIGHTS = [0.01, 0.04, 0.15, 0.3, 0.5]

_SHARES = """, padded as (select word, n_sources, '^^^' || word || '$' as p, unnest(generate_series(4, length(word) + 4)) as j from words),
ev as (select word, n_sources, j, substr(p, j, 1) as c, substr(p, j - 1, 1) as h1, substr(p, j - 2, 2) as h2, substr(p, j - 3, 3) as h3 from padded),
m0 as (select c, count(*) / sum(count(*)) over () as p from ev where n_sources >= 3 group by c),
m1 as (select h1, c, count(*) / sum(count(*)) over (partition by h1) as p from ev where n_sources >= 3 group by h1, c),
m2 as (select h2, c, count(*) / sum(count(*)) over (partition by h2) as p from ev where n_sources >= 3 group by h2, c),
m3 as (select h3, c, count(*) / sum(count(*)) over (partition by h3) as p from ev where n_sources >= 3 group by h3, c),
shares as (select ev.word, ev.n_sources, (0.01 / 27 + 0.04 * coalesce(m0.p, 0) + 0.15 * coalesce(m1.p, 0) + 0.3 * coalesce(m2.p, 0) + 0.5 * coalesce(m3.p, 0))
    / (0.05 + case when ev.h1 in (select h1 from m1) then 0.15 else 0 end + case when ev.h2 in (select h2 from m2) then 0.3 else 0 end + case when ev.h3 in (select h3 from m3) then 0.5 else 0 end) as p
    from ev left join m0 using (c) left join m1 on m1.h1 = ev.h1 and m1.c = ev.c left join m2 on m2.h2 = ev.h2 and m2.c = ev.c left join m3 on m3.h3 = ev.h3 and m3.c = ev.c)"""


def _scored(w: DataFrame) -> DataFrame:
    return models.char_shares(w, models.char_table(w.where("n_sources >= 3")))


@on_words("l04_word_scores", f"{_SHARES} select word, round(sum(log10(greatest(p, 1e-12))), 6) as log10_p, round(avg(log10(greatest(p, 1e-12))), 6) as per_char from shares group by word")
def _(w):
    return models.word_scores(_scored(w), WEIGHTS).select("word", F.round("log10_p", 6).alias("log10_p"), F.round("per_char", 6).alias("per_char"))


@on_words("f31_perplexity", f"{_SHARES} select n_sources >= 3 as trained, count(*) as events, round(pow(10, -avg(log10(greatest(p, 1e-12)))), 6) as perplexity from shares group by 1")
def _(w):
    each = models.kind_shares(w.withColumn("trained", F.col("n_sources") >= 3), models.char_table(w.where("n_sources >= 3")), "trained")
    p = F.log10(F.greatest(models.mixed(F.col("shares"), WEIGHTS), F.lit(1e-12)))
    n = F.sum("n")
    return each.groupBy("trained").agg(n.alias("events"), F.round(F.pow(F.lit(10.0), -F.sum(F.col("n") * p) / n), 6).alias("perplexity"))


@on_words("l03_char_weights")
def _(w):
    weights = models.interpolation_weights(models.kind_shares(w.where("n_sources < 3"), models.char_table(w.where("n_sources >= 3"))))
    return w.sparkSession.createDataFrame(list(enumerate(weights)), "k int, weight double")


_SAMPLED = r""", l as (select unnest(string_split('abcdefghijklmnopqrstuvwxyz', '')) as x), c27 as (select unnest(range(1, 28)) as place, unnest(string_split('abcdefghijklmnopqrstuvwxyz$', '')) as c),
padded as (select '^^^' || word || '$' as p, unnest(generate_series(4, length(word) + 4)) as j from words where n_sources >= 3),
ev as (select substr(p, j, 1) as c, substr(p, j - 1, 1) as h1, substr(p, j - 2, 2) as h2, substr(p, j - 3, 3) as h3 from padded),
m0 as (select c, count(*) / sum(count(*)) over () as p from ev group by c),
m1 as (select h1, c, count(*) / sum(count(*)) over (partition by h1) as p from ev group by h1, c),
m2 as (select h2, c, count(*) / sum(count(*)) over (partition by h2) as p from ev group by h2, c),
m3 as (select h3, c, count(*) / sum(count(*)) over (partition by h3) as p from ev group by h3, c),
hist as (select '^^^' as h3 union all select '^^' || x from l union all select '^' || a.x || b.x from l a, l b union all select a.x || b.x || d.x from l a, l b, l d),
mix as (select hist.h3, place, (0.01 / 27 + 0.04 * coalesce(m0.p, 0) + 0.15 * coalesce(m1.p, 0) + 0.3 * coalesce(m2.p, 0) + 0.5 * coalesce(m3.p, 0))
    / (0.05 + case when s1.h1 is not null then 0.15 else 0 end + case when s2.h2 is not null then 0.3 else 0 end + case when s3.h3 is not null then 0.5 else 0 end) as p
    from hist cross join c27 left join m0 using (c) left join m1 on m1.h1 = right(hist.h3, 1) and m1.c = c27.c left join m2 on m2.h2 = right(hist.h3, 2) and m2.c = c27.c left join m3 on m3.h3 = hist.h3 and m3.c = c27.c
    left join (select distinct h1 from m1) s1 on s1.h1 = right(hist.h3, 1) left join (select distinct h2 from m2) s2 on s2.h2 = right(hist.h3, 2) left join (select distinct h3 from m3) s3 on s3.h3 = hist.h3),
cum as materialized (select h3, list(s order by place) as upto from (select h3, place, sum(p) over (partition by h3 order by place) as s from mix) group by h3),
grow as (select word as tag, '' as made, '^^^' as h3, 0 as i from words where n_docs >= 3
    union all select tag, case when c = '$' then made else made || c end, case when c = '$' then null else right(h3, 2) || c end, i + 1
    from (select tag, made, grow.h3, i, 'abcdefghijklmnopqrstuvwxyz$'[least(27, len(list_filter(upto, lambda x: x < ('0x' || substr(sha256('pseudo:' || tag || ':' || i), 1, 16))::ubigint::double / 18446744073709551616.0)) + 1)] as c from grow join cum on cum.h3 = grow.h3 where i < 24)),
sampled as (select tag, arg_max(made, i) as made from grow group by tag)"""
_RECURSIVE = WORDS_SQL.lstrip()


def _sampled(w: DataFrame) -> DataFrame:
    """(tag, word): a word drawn from the character model for every attested word."""
    unit = lambda tag, i: fn.unit_hash(F.concat(F.lit("pseudo:"), tag, F.lit(":"), i.cast("string")))
    return models.sample_words(w.where("n_docs >= 3").select(F.col("word").alias("tag")), models.char_table(w.where("n_sources >= 3")), WEIGHTS, unit)


@on_tables("l05_sampled_words", f"with recursive {_RECURSIVE} {_SAMPLED} select tag, made as word from sampled")
def _(spark, sf_dir):
    return _sampled(words(spark, sf_dir))


@on_tables("l23_pseudo_controls", f"with recursive {_RECURSIVE} {_SAMPLED} select distinct made as control from sampled where length(made) between 2 and 24 and made not in (select word from words)")
def _(spark, sf_dir):
    w = words(spark, sf_dir)
    made = _sampled(w).where(F.length("word").between(2, 24)).select("word").distinct()
    return made.join(w.select("word"), "word", "left_anti").select(F.col("word").alias("control"))


#: Words of a control family at most.
FAMILY = 2000


@on_tables(
    "l23_foreign_controls",
    f"with {WORDS_SQL}, l as (select w, bool_or(lang = 'en') as english from tokens join documents using (doc_id) group by w) select w as control, sha256('foreign-family:' || w) as rank_key from l join words on word = w where not coalesce(english, false) and n_docs < 3 order by rank_key, w limit {FAMILY}",
)
def _(spark, sf_dir):
    # words of other languages alone that no detector confirms; the family is the top of a hash order
    english = tokens(table(spark, sf_dir, "documents").where("lang = 'en'")).select(F.col("w").alias("word")).distinct()
    pool = words(spark, sf_dir).where("n_docs < 3").select("word").join(english, "word", "left_anti")
    return pool.select(F.col("word").alias("control"), F.sha2(F.concat(F.lit("foreign-family:"), "word"), 256).alias("rank_key")).orderBy("rank_key", "control").limit(FAMILY)


@on_tables("l23_dictionary_controls", f"select distinct unnest(string_split(missing, ' ')) as control from ({ORACLE_SQL['d13_inflections']}) where outcome = 'inflection-absent' and missing <> ''")
def _(spark, sf_dir):
    absent = QUERIES["d13_inflections"](spark, sf_dir).where("outcome = 'inflection-absent' and missing <> ''")
    return absent.select(F.explode(F.split("missing", " ")).alias("control")).distinct()


@on_tables("f42_recapture", f"with {WORDS_SQL}, {_PATTERN} select *, round((only_first + \"both\" + 1) * (only_second + \"both\" + 1) / (\"both\" + 1) - 1, 6) as estimate from (select count(*) filter (a and not b) as only_first, count(*) filter (b and not a) as only_second, count(*) filter (a and b) as \"both\" from (select pattern & 63 > 0 as a, pattern & 4032 > 0 as b from evidence))")
def _(spark, sf_dir):
    return models.recapture(evidence(spark, sf_dir), 63, 4032).withColumn("estimate", F.round("estimate", 6))


@on_words(
    "f23_stratified_error",
    """, s as (select intake, count(*) as size, count(*) filter (first_doc % 10 = 0) as n, count(*) filter (llm_invalid) as k from words group by intake), u as (select size, k / n as p, n from s where n > 0)
select round(sum(size * p) / sum(size), 9) as estimate, round(sqrt(sum(size::double * size * case when n > 1 then p * (1 - p) / (n - 1) * (1 - n / size) else 0 end)) / sum(size), 9) as se from u""",
)
def _(w):
    strata = w.groupBy("intake").agg(F.count("*").alias("size"), F.count_if(F.col("first_doc") % 10 == 0).alias("n"), F.count_if("llm_invalid").alias("k"))
    return models.stratified_error(strata).select(F.round("estimate", 9).alias("estimate"), F.round("se", 9).alias("se"))


@on_words("f24_totals", "select coalesce(intake, 'Total') as intake, count(*) as n, count(*) filter (llm_invalid) as contested from words group by rollup (intake)")
def _(w):
    return w.rollup("intake").agg(F.count("*").alias("n"), F.count_if("llm_invalid").alias("contested")).select(F.coalesce("intake", F.lit("Total")).alias("intake"), "n", "contested")


@on_words("f37_top_letter", "select pos, letter, n from (select pos, letter, count(*) as n, row_number() over (partition by pos order by count(*) desc, letter) as r from (select unnest(string_split(word, '')) as letter, generate_subscripts(string_split(word, ''), 1)::int as pos from words) where pos <= 12 group by pos, letter) where r = 1")
def _(w):
    by = w.select(F.posexplode(F.split(F.left("word", F.lit(12)), "")).alias("p", "letter")).groupBy((F.col("p") + 1).alias("pos"), "letter").agg(F.count("*").alias("n"))
    return by.groupBy("pos").agg(F.min(F.struct((-F.col("n")).alias("less"), "letter")).alias("top")).select("pos", "top.letter", (-F.col("top.less")).alias("n"))


@on_words("f48_comparatives", "select stem, string_agg(form, ',' order by form) as forms, count(*) as n from (select f.word as form, s.word as stem from words f join words s on f.word = s.word || 'er' where length(f.word) > 4 union all select f.word, s.word from words f join words s on f.word = s.word || 'est' where length(f.word) > 4) group by stem")
def _(w):
    form = F.col("word")
    cut = w.where((F.length(form) > 4) & form.rlike("(er|est)$")).select(form.alias("form"), F.regexp_replace(form, "(er|est)$", "").alias("stem"))
    each = cut.join(w.select(form.alias("stem")), "stem", "left_semi")
    return each.groupBy("stem").agg(F.concat_ws(",", F.sort_array(F.collect_set("form"))).alias("forms"), F.count("*").alias("n"))


@on_words(
    "g06_largest_remainder",
    """, c as (select word[1] as letter, count(*) as n from words group by 1), q as (select letter, n, 1000 * n // sum(n) over () as whole, 1000 * n % sum(n) over () as rest from c)
select letter, n, (whole + case when row_number() over (order by rest desc, letter) <= 1000 - sum(whole) over () then 1 else 0 end)::bigint as target from q""",
)
def _(w):
    # at most one row a letter from here on
    by = w.groupBy(F.left("word", F.lit(1)).alias("letter")).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    by = by.withColumn("total", F.sum("n").over(every)).selectExpr("letter", "n", "1000 * n div total as whole", "1000 * n % total as rest")
    more = F.row_number().over(Window.orderBy(F.desc("rest"), "letter")) <= 1000 - F.sum("whole").over(every)
    return by.select("letter", "n", (F.col("whole") + more.cast("long")).alias("target"))


@on_words(
    "k35_quality",
    """, l as (select word, length(word) as length, unnest(string_split(word, '')) as letter, generate_subscripts(string_split(word, ''), 1) as pos from words),
f as (select letter, count(*) / sum(count(*)) over () as share from l group by letter),
q as (select length, pos, letter, count(*) / sum(count(*)) over (partition by length, pos) as share from l group by length, pos, letter),
v as (select avg(length(regexp_replace(word, '[^aeiou]', '', 'g')) / length(word)) as mean from words),
a as (select word, greatest(0, least(1, 1 - (sum(abs(n / length - share)) + 1 - sum(share)) / 2)) as alike, count(*) / any_value(length) as varied from (select word, length, letter, count(*) as n from l group by all) join f using (letter) group by word),
b as (select word, avg(share) as placed from l join q using (length, pos, letter) group by word)
select word, round(0.45 * alike + 0.3 * placed + 0.15 * greatest(0, least(1, 1 - abs(length(regexp_replace(word, '[^aeiou]', '', 'g')) / length(word) - mean))) + 0.1 * varied, 6) as quality from a join b using (word), v""",
)
def _(w):
    # the tables of letters and places depend on the alphabet and the word lengths, not on the number of words
    length = F.length("word")
    each = w.select("word", length.alias("length"), F.posexplode(F.split("word", "")).alias("pos", "letter"))
    places = each.groupBy("length", "pos", "letter").agg(F.count("*").alias("n"))
    letters = places.groupBy("letter").agg(F.sum("n").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).drop("n")
    places = places.withColumn("place_share", F.col("n") / F.sum("n").over(Window.partitionBy("length", "pos"))).drop("n")
    mean = w.agg(F.avg(fn.vowel_ratio(F.col("word"))).alias("mean"))
    by = each.join(places, ["length", "pos", "letter"]).groupBy("word", "length", "letter").agg(F.count("*").alias("n"), F.sum("place_share").alias("placed")).join(letters, "letter")
    alike = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - (F.sum(F.abs(F.col("n") / F.col("length") - F.col("share"))) + 1 - F.sum("share")) / 2))
    scores = by.groupBy("word", "length").agg(alike.alias("alike"), (F.sum("placed") / F.col("length")).alias("placed"), (F.count("*") / F.col("length")).alias("varied"))
    # the mean is one row
    balance = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(fn.vowel_ratio(F.col("word")) - F.col("mean"))))
    quality = 0.45 * F.col("alike") + 0.3 * F.col("placed") + 0.15 * balance + 0.1 * F.col("varied")
    return scores.join(F.broadcast(mean), F.lit(True)).select("word", F.round(quality, 6).alias("quality"))
