"""Scalar functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters whose case-folded form has more than one letter, or another letter.
FOLDED = {"ß": "ss", "ſ": "s", "ẞ": "ss", "K": "k", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def normalise(text: Column) -> Column:
    """The case-folded word if it is plain a-z, else null."""
    for letter, plain in FOLDED.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    text = F.lower(text)
    return F.when(text.rlike(r"^[a-z]+\z"), text)


def form_reason(word: Column, least: int | None = 2, most: int | None = 45) -> Column:
    """Why a word's form is refused (the first reason that holds), or null."""
    out = F.when((word.isNull()) | (word == ""), "empty").when(word != F.lower(word), "uppercase").when(~word.rlike(r"^[a-z]+\z"), "non-alphabetic")
    if least is not None:
        out = out.when(F.length(word) < least, "too short")
    if most is not None:
        out = out.when(F.length(word) > most, "too long")
    return out


def glob(word: Column, pattern: str) -> Column:
    """'_' is one byte, '*' any run of bytes; everything else is literal."""
    like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("*", "%")
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1").like(like.encode().decode("latin-1"))


def charset(word: Column, kind: str) -> Column:
    """any, alpha (no hyphen, ASCII), hyphen or accent."""
    return {"any": F.lit(True), "alpha": word.rlike(r"^[a-z]+\z"), "hyphen": word.contains("-"), "accent": F.octet_length(word) != F.length(word)}[kind]


def vowel_ratio(word: Column) -> Column:
    return F.when(F.length(word) == 0, 0.0).otherwise(F.length(F.regexp_replace(word, "[^aeiou]", "")) / F.length(word))


def fnv1a(word: Column) -> Column:
    """32-bit FNV-1a of an ASCII word."""
    codes = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.ascii(F.substr(word, i, F.lit(1))).cast("long"))
    return F.aggregate(codes, F.lit(2166136261).cast("long"), lambda h, c: (h.bitwiseXOR(c) * 16777619).bitwiseAND(4294967295))


def unit_hash(key: Column) -> Column:
    """A number in [0, 1) from the first 64 bits of the SHA-256 of key."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of the Wilson interval; (0, 1) without trials."""
    p, zz = hits / n, z * z
    centre, width = p + zz / (2 * n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    return F.when(n == 0, 0.0).otherwise((centre - width) / (1 + zz / n)), F.when(n == 0, 1.0).otherwise((centre + width) / (1 + zz / n))


def edits(word: Column) -> Column:
    """Distinct strings one deletion, transposition, replacement or insertion away."""
    n, letters = F.length(word), F.split(F.lit("abcdefghijklmnopqrstuvwxyz"), "")
    left = lambda i: F.substr(word, F.lit(1), i)
    right = lambda i: F.substr(word, i + 1)
    at = F.sequence(F.lit(0), n - 1)
    deleted = F.transform(at, lambda i: F.concat(left(i), right(i + 1)))
    swapped = F.transform(F.filter(at, lambda i: i < n - 1), lambda i: F.concat(left(i), F.substr(word, i + 2, F.lit(1)), F.substr(word, i + 1, F.lit(1)), right(i + 2)))
    replaced = F.flatten(F.transform(at, lambda i: F.transform(letters, lambda c: F.concat(left(i), c, right(i + 1)))))
    inserted = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.transform(letters, lambda c: F.concat(left(i), c, right(i)))))
    return F.array_remove(F.array_distinct(F.concat(deleted, swapped, replaced, inserted)), word)


def _log_density(x: Column) -> Column:
    return -x * x / 2 - 0.9189385332046727  # half the log of 2 pi


def log_normal_cdf(x: Column) -> Column:
    """log of the standard normal distribution function: a power series, and below -2 a continued fraction, which stays exact far out."""
    odd = F.aggregate(F.sequence(F.lit(1), F.lit(200)), F.struct(x.alias("term"), x.alias("sum")), lambda s, k: F.struct((s["term"] * x * x / (2 * k + 1)).alias("term"), (s["sum"] + s["term"] * x * x / (2 * k + 1)).alias("sum")))
    near = F.log(0.5 + F.exp(_log_density(x)) * odd["sum"])
    z = F.abs(x)
    tail = _log_density(z) - F.log(F.aggregate(F.sequence(F.lit(150), F.lit(1), F.lit(-1)), z, lambda f, k: z + k / f))
    return F.when(x < -2, tail).when(x > 2, F.log1p(-F.exp(tail))).otherwise(near)


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function."""
    return F.exp(log_normal_cdf(x))


def normal_quantile(p: Column) -> Column:
    """Its inverse, by Halley's steps from a first guess; null outside (0, 1)."""
    low = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(low))
    # A rational first guess
    guess = -(t - (2.30753 + 0.27061 * t) / (1 + 0.99229 * t + 0.04481 * t * t))

    def nearer(x: Column, _: Column) -> Column:
        gap = (normal_cdf(x) - low) / F.exp(_log_density(x))
        return x - gap / (1 + x * gap / 2)

    x = F.aggregate(F.sequence(F.lit(1), F.lit(4)), guess, nearer)
    return F.when((p > 0) & (p < 1), F.when(p < 0.5, x).otherwise(-x))


def iso_utc(ts: Column) -> Column:
    """A timestamp as ISO 8601 in UTC, to the second, with Z."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
