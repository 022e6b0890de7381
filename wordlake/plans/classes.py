"""Registered queries over detector patterns, model checks, calibration and update logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classes, lists, stats
from ..sources.files import first_seen
from ..sources.lexicon import WORDS_SQL, table, words
from .queries import _LISTS, _ORDINAL, _PATTERN, ORACLE_SQL, QUERIES, _valid_invalid, evidence, on_tables, on_words, yearly

DETECTORS = 12
#: Pairs of detectors that may depend on each other.
EDGES = ((0, 1), (0, 2), (1, 2), (3, 4), (4, 5), (6, 7), (8, 9), (9, 10), (10, 11))
_CELLS = f"with {WORDS_SQL}, {_PATTERN}, cells as (select pattern, count(*) as n from evidence group by pattern)"


def _cells(spark, sf_dir):
    return evidence(spark, sf_dir).groupBy("pattern").agg(F.count("*").alias("n"))


@on_tables("d06_source_codes", "select source, row_number() over (order by min(doc_id), source) - 1 as code from documents where source is not null group by source")
def _(spark, sf_dir):
    return first_seen(table(spark, sf_dir, "documents").where("source is not null"), "source", "doc_id")


@on_tables("e05_counts_with_defaults", f"with {WORDS_SQL}, c as (select w, count(*) as match, count(distinct doc_id) as volume from tokens where {_ORDINAL} = 0 group by w) select word, coalesce(match, 0) as match, coalesce(volume, 0) as volume, round(log10(1 + coalesce(match, 0)), 9) as log_match from words left join c on c.w = word")
def _(spark, sf_dir):
    counts = yearly(spark, sf_dir).where("year = 0").select(F.col("w").alias("word"), "match", "volume")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return words(spark, sf_dir).join(counts, "word", "left").select("word", zero("match").alias("match"), zero("volume").alias("volume"), F.round(F.log10(1 + zero("match")), 9).alias("log_match"))


@on_words("e17_label_join", "select w.intake, count(*) as n, count(v.word) as listed, round(count(v.word) / count(*), 9) as share from words w left join (select word from words where n_docs >= 3) v on v.word = w.word group by w.intake")
def _(w):
    held = w.where("n_docs >= 3").select("word", F.lit(True).alias("listed"))
    by = w.join(held, "word", "left").groupBy("intake").agg(F.count("*").alias("n"), F.count("listed").alias("listed"))
    return by.withColumn("share", F.round(F.col("listed") / F.col("n"), 9))


@on_tables("e18_cells", f"{_CELLS} select i::int as pattern, coalesce(n, 0) as n from generate_series(0, 4095) as t(i) left join cells on pattern = i")
def _(spark, sf_dir):
    cells = spark.range(1 << DETECTORS).select(F.col("id").cast("int").alias("pattern"))
    return cells.join(_cells(spark, sf_dir), "pattern", "left").select("pattern", F.coalesce("n", F.lit(0)).alias("n"))


@on_tables("e19_edge_products", f"{_CELLS} select j::int as j, k::int as k, sum(case when (pattern >> j) & (pattern >> k) & 1 = 1 then n else 0 end)::bigint as n from cells, (values {', '.join(map(str, EDGES))}) as e(j, k) group by j, k")
def _(spark, sf_dir):
    return classes.edge_counts(_cells(spark, sf_dir), EDGES)


@on_tables(
    "f41_em_step",
    f"""{_CELLS}, p as (select pattern, n, 1 / (1 + exp(bit_count(pattern) * ln(0.2 / 0.7) + (12 - bit_count(pattern)) * ln(0.8 / 0.3))) as post from cells)
select d as detector, round(sum(n * post * ((pattern >> d) & 1)), 6) as mass, round((sum(n * post * ((pattern >> d) & 1)) + 1) / (sum(n * post) + 2), 9) as rate from p, (select unnest(generate_series(0, 11))::int as d) group by d""",
)
def _(spark, sf_dir):
    found = classes.em_step(_cells(spark, sf_dir), 0.5, [0.7] * DETECTORS, [0.2] * DETECTORS)
    return found.select("detector", F.round("mass", 6).alias("mass"), F.round("rate", 9).alias("rate"))


@on_tables("f43_least_bic", f"select arg_min(beta, bic) as beta, round(min(bic), 3) as bic from (select beta, 400 * ln(sse / 400) + 3 * ln(400) as bic from ({ORACLE_SQL['f33_rank_law']}))")
def _(spark, sf_dir):
    laws = QUERIES["f33_rank_law"](spark, sf_dir).withColumn("bic", classes.bic(F.col("sse"), 400, 3))
    return laws.agg(F.min_by("beta", "bic").alias("beta"), F.round(F.min("bic"), 3).alias("bic"))


@on_words(
    "f44_parameter_error",
    """, l as (select n_sources >= 3 as a, unnest(string_split(word, '')) as letter from words), s as (select letter, count(*) filter (a) / sum(count(*) filter (a)) over () as p, count(*) filter (not a) / sum(count(*) filter (not a)) over () as q from l group by letter)
select round(max(abs(p - q)), 9) as error, max(abs(p - q)) <= 0.02 as within from s""",
)
def _(w):
    letters = w.select((F.col("n_sources") >= 3).alias("a"), F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count_if("a").alias("x"), F.count_if(~F.col("a")).alias("y"))
    sums = letters.agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"))  # one row
    error = F.max(F.abs(F.col("x") / F.col("sx") - F.col("y") / F.col("sy")))
    return letters.join(F.broadcast(sums), F.lit(True)).agg(F.round(error, 9).alias("error"), (error <= 0.02).alias("within"))


@on_words("f45_digest", "select sha256(string_agg(d, '' order by part)) as digest, sum(n)::bigint as n from (select substr(h, 1, 3) as part, sha256(string_agg(h, '' order by h)) as d, count(*) as n from (select sha256(word || ':' || n_tokens) as h from words) group by 1)")
def _(w):
    return stats.digest(w, "word", "n_tokens")


@on_words("f46_recorded_sums", "select intake, sum(try_cast(raw as bigint))::bigint as total from (select intake, case when n_tokens % 7 = 0 or intake = 'synthetic' then 'not recorded' else n_tokens::varchar end as raw from words) group by intake")
def _(w):
    raw = F.when((F.col("n_tokens") % 7 == 0) | (F.col("intake") == "synthetic"), "not recorded").otherwise(F.col("n_tokens").cast("string"))
    return w.groupBy("intake").agg(F.sum(raw.try_cast("long")).alias("total"))


@on_words("f47_promotion_rate", f", {_LISTS} select count(*) filter (n_tokens >= 5) as promoted, count(*) filter (n_tokens < 5) as remaining, round(count(*) filter (n_tokens >= 5) / count(*), 9) as rate from invalid join words using (word)")
def _(w):
    _, invalid = _valid_invalid(w)
    sums = w.join(invalid, "word", "left_semi").agg(F.count_if(F.col("n_tokens") >= 5).alias("promoted"), F.count_if(F.col("n_tokens") < 5).alias("remaining"))
    return sums.withColumn("rate", F.round(F.col("promoted") / (F.col("promoted") + F.col("remaining")), 9))


_FEATURES = ("n_tokens", "n_docs", "length")
_FAMILIES = {"contested": "llm_invalid", "attested": "n_sources >= 8"}
_GRID = " union all ".join(f"select '{f}' as family, '{x}' as feature, ({y})::int as y, {x if x != 'length' else 'length(word)'} as score from words" for f, y in _FAMILIES.items() for x in _FEATURES)


@on_words(
    "l24_gate_report",
    f""", g as ({_GRID}), r as (select family, feature, y, rank() over (partition by family, feature order by score) + (count(*) over (partition by family, feature, score) - 1) / 2 as r from g)
select family, feature, sum(y)::bigint as positives, sum(1 - y)::bigint as negatives, case when least(sum(y), sum(1 - y)) >= 10 then round((sum(r * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 9) end as auc from r group by family, feature""",
)
def _(w):
    families = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.expr(y).alias("label")) for f, y in _FAMILIES.items()])).alias("f")
    score = {"n_tokens": F.col("n_tokens"), "n_docs": F.col("n_docs"), "length": F.length("word").cast("long")}
    each = w.select(families, *[c.alias(f"s_{x}") for x, c in score.items()])
    grid = each.select("f.*", F.explode(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"s_{x}").alias("score")) for x in score])).alias("x")).select("family", "label", "x.*")
    return stats.auc(grid, ["family", "feature"]).withColumn("auc", F.round("auc", 9))


@on_tables("l25_evidence_gate", f"{_CELLS}, s as (select sum(n)::bigint as n, sum(n) filter (bit_count(pattern) <= 1) / sum(n) as one_at_most, sum(n) filter ((pattern & 63) = 0) / sum(n) as none_of_six from cells) select n, round(one_at_most, 9) as one_at_most, round(none_of_six, 9) as none_of_six, one_at_most > 0.5 as first_fails, none_of_six > 0.5 as second_fails from s")
def _(spark, sf_dir):
    share = lambda c: F.sum(F.when(c, F.col("n"))) / F.sum("n")
    one, none = share(F.bit_count("pattern") <= 1), share(F.col("pattern").bitwiseAND(63) == 0)
    return _cells(spark, sf_dir).agg(F.sum("n").alias("n"), F.round(one, 9).alias("one_at_most"), F.round(none, 9).alias("none_of_six"), (one > 0.5).alias("first_fails"), (none > 0.5).alias("second_fails"))


@on_words(
    "l26_reliability",
    """, p as (select least(1, n_docs / 10) as p, n_sources >= 3 as y from words), b as (select least(9, floor(p * 10))::int as bin, count(*) as n, avg(p) as mean, count(*) filter (y) / count(*) as rate from p group by 1)
select bin, n, round(mean, 9) as mean, round(rate, 9) as rate, round(n / sum(n) over () * abs(mean - rate), 9) as error_part from b""",
)
def _(w):
    scored = w.select(F.least(F.lit(1.0), F.col("n_docs") / 10).alias("p"), (F.col("n_sources") >= 3).alias("y"))
    return stats.reliability(scored, "p", "y")


@on_words(
    "l26_agreement",
    """, s as (select count(*) as n, count(*) filter (a and b) as tp, count(*) filter (a and not b) as fp, count(*) filter (b and not a) as fn, count(*) filter (not a and not b) as tn from (select n_docs >= 3 as a, n_sources >= 2 as b from words))
select n, round(((tp + tn) / n - ((tp + fp) / n * ((tp + fn) / n) + (fn + tn) / n * ((fp + tn) / n))) / (1 - ((tp + fp) / n * ((tp + fn) / n) + (fn + tn) / n * ((fp + tn) / n))), 9) as kappa,
    round(tp / (tp + fn), 9) as sensitivity, round(tn / (tn + fp), 9) as specificity, round(((tp + fp) / n + tn / (tn + fp) - 1) / (tp / (tp + fn) + tn / (tn + fp) - 1), 9) as prevalence from s""",
)
def _(w):
    return stats.agreement(w.select((F.col("n_docs") >= 3).alias("a"), (F.col("n_sources") >= 2).alias("b")), "a", "b")


@on_tables(
    "b05_log_upsert",
    """with o as (select o_orderdate::date as dt, count(*) as n, count(*) filter (o_orderkey % 3 <> 0) as k from orders group by 1), old as (select dt, k as n, row_number() over (order by dt) as update_number from o where k > 0 and day(dt) <> 15), new as (select dt, n from o where day(dt) in (1, 15))
select old.dt::varchar as day, coalesce(new.n, old.n) as n, update_number from old left join new using (dt)
union all select new.dt::varchar, new.n, (select max(update_number) from old) + row_number() over (order by new.dt) from new anti join old using (dt)""",
)
def _(spark, sf_dir):
    # one row a day from here on
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderkey") % 3 != 0).alias("k"))
    old = lists.numbered_log(days.where("k > 0 and day(day) <> 15").select("day", F.col("k").alias("n")))
    return lists.upsert_log(old, days.where("day(day) in (1, 15)").select("day", "n")).withColumn("day", F.col("day").cast("string"))


@on_words("b06_snapshot", "select count(*) as words, sum(n_tokens)::bigint as tokens, count(*) filter (intake = 'twl') as twl, count(*) filter (llm_invalid) as contested, max(length(word))::int as longest, max(added)::varchar as last_added from words")
def _(w):
    return w.agg(F.count("*").alias("words"), F.sum("n_tokens").alias("tokens"), F.count_if(F.col("intake") == "twl").alias("twl"), F.count_if("llm_invalid").alias("contested"), F.max(F.length("word")).alias("longest"), F.max("added").cast("string").alias("last_added"))


@on_words("b22_recheck_queue", "select word from words where intake = 'other' and n_docs = 1 union select word from words where llm_invalid")
def _(w):
    return w.where("intake = 'other' and n_docs = 1").select("word").union(w.where("llm_invalid").select("word")).distinct()
