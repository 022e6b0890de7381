"""Word forms as Column expressions: affixes and stems, scanning confusions, likely-English rules, priority scores.

Candidates come as arrays, in the order in which the first that is attested wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Affixes, rules and weights whose results must be the usual ones.

SUFFIXES = (
    "s es ed ing ings er ers est ly ness nesses ish able ible ation ations ize ise ized ised izes ises izing ising ic al ous "
    "ment ments ity ities less ful dom hood ship like oses osis ette ism isms ist ists"
).split()
PREFIXES = "un non re de anti pre over under out micro pseudo quasi super sub inter intra multi".split()
LEAST_STEM = 3
#: (suffix, what may follow the bare stem) of comparatives, and (suffix, stratum, what may follow) of inflections, in the order tried.
COMPARATIVES = (("est", ("", "e")), ("er", ("", "e")))
INFLECTIONS = (("ings", "gerund-plural", ("", "e")), ("ers", "agent-plural", ("", "e")), ("ing", "verb-form", ("", "e")), ("ed", "verb-form", ("", "e")), ("es", "plural", ("", "e")), ("s", "plural", ("",)))
#: (what stood in print, what a scan makes of it).
CONFUSIONS = (("m", "in"), ("rn", "m"), ("l", "i"), ("e", "c"), ("c", "e"), ("li", "h"))
#: Prefixes that make compounds without end, those of real words, common suffixes, first letters that are common.
PRODUCTIVE = "anti non pre post multi semi pseudo quasi ultra super hyper mega micro macro neo proto counter inter intra extra trans".split()
REAL_PREFIXES = "un re dis mis over out under".split()
COMMON_SUFFIXES = "ing ed er est ly tion sion ness ment able ible ful less ous ive al ical ity ance ence ism ist".split()
COMMON_FIRST = "stcpbdmrahfglewn"
#: What no likely English word holds.
UNLIKELY = (
    r"(.)\1{2,}", r"[^aeiou]{5,}", r"[aeiou]{4,}", r"q(?!u)", r"[jkqvwxz]{3,}", r"[^a-z]", r"szcz|zcz|tsz|cz[aeiou]", r"ough$|ght$",
    r"schw|tsch", r"^[^aeiou]{4}", r"[^aeiou]{4}$", r"kh|gh[^t]|zh|dj",
)


def _cut(word: Column, suffix: str) -> Column:
    return F.left(word, F.length(word) - len(suffix))


def _double(stem: Column, least: int, but: str = "") -> Column:
    """The stem without the second of two equal letters at its end."""
    last = F.right(stem, F.lit(1))
    twice = (F.length(stem) >= least) & (last == F.substr(stem, F.length(stem) - 1, F.lit(1)))
    return F.when(twice & ~last.isin(*but) if but else twice, F.left(stem, F.length(stem) - 1))


def _with_y(stem: Column) -> Column:
    return F.when(stem.endswith("i"), F.concat(F.left(stem, F.length(stem) - 1), F.lit("y")))


def stem_variants(stem: Column) -> Column:
    """The stem itself, with an e, with one of two equal last letters, with y for i; what does not apply is null."""
    return F.array(stem, F.concat(stem, F.lit("e")), _double(stem, 2), _with_y(stem))


def _stems(word: Column, suffix: str, extras: tuple[str, ...]) -> list[Column]:
    base = _cut(word, suffix)
    return [F.concat(base, F.lit(x)) for x in extras] + [_double(base, 4, "aeiou"), _with_y(base)]


def comparative_stems(word: Column) -> Column:
    """Candidate stems of a comparative or superlative."""
    each = [F.when(word.endswith(s) & (F.length(word) - len(s) >= LEAST_STEM), c) for s, extras in COMPARATIVES for c in _stems(word, s, extras)]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def inflection_stems(word: Column) -> Column:
    """Candidates (rule, stratum, stem) of an inflected word, rule by rule."""
    each = [
        F.when(word.endswith(s) & (F.length(word) - len(s) >= LEAST_STEM) & c.isNotNull(), F.struct(F.lit(i * 8 + j).alias("place"), F.lit(stratum).alias("stratum"), c.alias("stem")))
        for i, (s, stratum, extras) in enumerate(INFLECTIONS) for j, c in enumerate(_stems(word, s, extras))
    ]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def suffix_parses(word: Column) -> Column:
    """Candidates (place, affix, stem), the longest suffix first."""
    order = sorted(SUFFIXES, key=len, reverse=True)
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("affix")) for i, s in enumerate(order)])
    fits = F.filter(table, lambda t: word.endswith(t["affix"]) & (F.length(word) - F.length(t["affix"]) >= LEAST_STEM))
    each = F.transform(fits, lambda t: F.transform(stem_variants(F.left(word, F.length(word) - F.length(t["affix"]))), lambda v, j: F.struct((t["i"] * 4 + j).alias("place"), t["affix"].alias("affix"), v.alias("stem"))))
    return F.filter(F.flatten(each), lambda x: x["stem"].isNotNull())


def prefix_parses(word: Column) -> Column:
    order = sorted(PREFIXES, key=len, reverse=True)
    table = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(p).alias("affix")) for i, p in enumerate(order)])
    fits = F.filter(table, lambda t: word.startswith(t["affix"]) & (F.length(word) - F.length(t["affix"]) >= LEAST_STEM))
    return F.transform(fits, lambda t: F.struct(t["place"].alias("place"), t["affix"].alias("affix"), F.substr(word, F.length(t["affix"]) + 1).alias("stem")))


def replaced_once(word: Column, pairs) -> Column:
    """The word with one place of a pair's first part replaced by the second: every pair in turn, its places from left to right."""

    def each(a: str, b: str) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: F.substr(word, i, F.lit(len(a))) == a)
        return F.transform(places, lambda i: F.concat(F.left(word, i - 1), F.lit(b), F.substr(word, i + len(a))))

    return F.concat(*[each(a, b) for a, b in pairs])


def scan_sources(word: Column) -> Column:
    """What may have stood in print where a scan gave the word."""
    return F.array_remove(F.array_distinct(replaced_once(word, [(art, src) for src, art in CONFUSIONS])), word)


def scanned_forms(word: Column) -> Column:
    """What a scan may make of the word: word is one of scan_sources() of each."""
    return F.array_remove(F.array_distinct(replaced_once(word, CONFUSIONS)), word)


def misread(word: Column, unit: Column) -> Column:
    """One misreading of the word, its place chosen by unit in [0, 1); null where nothing can be misread."""
    sites = replaced_once(word, CONFUSIONS)
    n = F.size(sites)
    return F.when(n > 0, F.get(sites, (F.floor(unit * n) % n).cast("int")))


def vowels(word: Column) -> Column:
    return F.length(F.regexp_replace(word, "[^aeiou]", ""))


def compound(word: Column) -> Column:
    """Whether the word is a productive prefix and more than three letters."""
    return F.exists(F.array(*map(F.lit, PRODUCTIVE)), lambda p: word.startswith(p) & (F.length(word) > F.length(p) + 3))


def likely_english(word: Column) -> Column:
    ratio = vowels(word) / F.length(word)
    return F.length(word).between(3, 15) & ~word.rlike("|".join(f"(?:{p})" if "\\1" not in p else p for p in UNLIKELY)) & ratio.between(0.15, 0.6) & ~compound(word)


def priority(word: Column) -> Column:
    """0 to 100: how worthwhile a look-up of the word is."""
    n = F.length(word)
    has = lambda names, fits: F.exists(F.array(*map(F.lit, names)), fits) & (n <= 10)
    points = [
        F.when(n.between(3, 5), 25).when(n.between(6, 8), 15).when(n.between(9, 12), 5).when(n == 2, 10).when(n.between(13, 16), -10).otherwise(-30),
        F.when(compound(word), -35).otherwise(0),
        F.when(has(REAL_PREFIXES, lambda p: word.startswith(p) & (n > F.length(p) + 2)), 5).otherwise(0),
        F.when(has(COMMON_SUFFIXES, lambda s: word.endswith(s) & (n > F.length(s) + 2)), 5).otherwise(0),
        F.when((vowels(word) / n).between(0.25, 0.5), 10).otherwise(-10),
        F.when(F.left(word, F.lit(1)).isin(*COMMON_FIRST), 5).otherwise(0),
        F.when(F.size(F.array_distinct(F.split(word, ""))) >= n * 0.6, 5).otherwise(0),
    ]
    return F.least(F.lit(100), F.greatest(F.lit(0), sum(points, F.lit(50))))
