"""Readers of word lists, dictionaries, logs and count files as DataFrames; compressed files open by their ending."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.words import normalise


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word): the distinct lines without blanks around them; blank lines are left out."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+\z", "").alias("word")).where("word <> ''").distinct()


def list_lines(spark: SparkSession, path: str) -> DataFrame:
    """(word): the lines as they are, CR LF or LF, blank ones left out; their order is that of their bytes."""
    return spark.read.text(path).select(F.rtrim(F.regexp_replace("value", r"\r\z", "")).alias("word")).where("word <> ''")


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """One row (n): lines that are not blank, repeated ones counted."""
    return spark.read.text(path).agg(F.count_if(F.col("value").rlike(r"\S")).alias("n"))


def _commas(spark: SparkSession, path: str) -> DataFrame:
    """Files cut at commas: (file, block, id, value, odd, out, own): pieces in the order of id within a block of a file.

    odd: the piece holds an odd number of quotes; out and own: how much deeper
    the nesting gets, if the piece begins outside or inside of a string.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    cut = F.split(F.regexp_replace("value", r"\\[\s\S]", ""), '"')  # without escaped characters
    deeper = lambda x: F.length(F.regexp_replace(x, r"[^\[{]", "")) - F.length(F.regexp_replace(x, r"[^\]}]", ""))
    side = lambda r: F.aggregate(F.filter("cut", lambda x, i: i % 2 == r), F.lit(0), lambda s, x: s + deeper(x))
    return pieces.withColumn("cut", cut).select("file", "block", "id", "value", (F.size("cut") % 2 == 0).cast("int").alias("odd"), side(0).alias("out"), side(1).alias("own"))


def object_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(file, pair, text): the pairs of files that hold one JSON object each, as text, in order.

    A file of any size is read by many tasks: it is cut at commas, and whether a
    comma stands between two pairs follows from the quotes and brackets before
    it.  Blocks of a file tell what they add to these counts for either state at
    their start, and a sum over the blocks, a row each, gives the state.  A file
    that ends within a pair is an error.
    """
    block = Window.partitionBy("file", "block").orderBy("id")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    each = _commas(spark, path).withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    each = each.withColumn("d0", F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("own"))).withColumn("d1", F.when(F.col("inside") == 0, F.col("own")).otherwise(F.col("out")))
    blocks = each.groupBy("file", "block").agg(F.sum("odd").alias("odds"), F.sum("d0").alias("s0"), F.sum("d1").alias("s1"))
    # a row a block from here on
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("state", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("gain", F.when(F.col("state") == 0, F.col("s0")).otherwise(F.col("s1"))).withColumn("depth", F.coalesce(F.sum("gain").over(earlier), F.lit(0)))
    last = blocks.groupBy("file").agg(F.sum("odds").alias("odds"), F.sum("gain").alias("gain")).where("odds % 2 <> 0 or gain <> 0").limit(1).collect()
    if last:
        raise ValueError(f"{last[0]['file']} does not end with its object")
    known = each.join(F.broadcast(blocks.select("file", "block", "state", "depth")), ["file", "block"])
    gain = F.when(F.col("state") == 0, F.col("d0")).otherwise(F.col("d1"))
    at_end = (F.col("state") + F.col("inside") + F.col("odd")) % 2  # in a string or not after the piece
    known = known.withColumn("deep", F.col("depth") + F.sum(gain).over(block)).withColumn("ends", ((at_end == 0) & (F.col("deep") == 1)).cast("int"))
    sums = known.groupBy("file", "block").agg(F.sum("ends").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    numbered = known.join(F.broadcast(sums.select("file", "block", "first")), ["file", "block"])
    numbered = numbered.select("file", (F.col("first") + F.coalesce(F.sum("ends").over(before), F.lit(0))).alias("pair"), F.struct("block", "id", "value").alias("piece"))
    whole = numbered.groupBy("file", "pair").agg(F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["value"]), ",").alias("text"))
    ends = whole.groupBy("file").agg(F.max("pair").alias("last"))  # a row a file
    text = F.when(F.col("pair") == 0, F.regexp_replace("text", r"^[^{]*\{", "")).otherwise(F.col("text"))
    whole = whole.withColumn("text", text).join(F.broadcast(ends), "file")
    text = F.when(F.col("pair") == F.col("last"), F.regexp_replace("text", r"\}\s*\z", "")).otherwise(F.col("text"))
    return whole.select("file", "pair", F.trim(F.regexp_replace(text, r"^\s+|\s+\z", "")).alias("text")).where("text <> ''")


def dictionary(spark: SparkSession, path: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """(word, entry), or (word, *fields): the pairs of files that hold one JSON object each; of a repeated key in a file the last counts.

    Files are cut between their pairs and read by many tasks, so they may be
    large; a pair must fit a task.  Fields that an entry lacks are null.
    """
    pairs = object_pairs(spark, path).select("file", "pair", F.explode(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "map<string,string>")).alias("word", "entry"))
    pairs = pairs.groupBy("file", "word").agg(F.max_by("entry", "pair").alias("entry"))
    return pairs.select("word", *[F.get_json_object("entry", f"$.{f}").alias(f) for f in fields]) if fields else pairs.select("word", "entry")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The rows of CSV files with a header; quotes in quoted fields are doubled, fields may hold line ends."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)


def distribution(spark: SparkSession, path: str) -> DataFrame:
    """(key, n) of CSV files of two columns with a header; no rows at all if a count is no number."""
    rows = spark.read.csv(path, header=True, schema="key string, raw string").select("key", F.col("raw").try_cast("long").alias("n"))
    bad = rows.where("n is null").limit(1).select(F.lit(True).alias("bad"))
    return rows.join(F.broadcast(bad), F.lit(True), "left_anti")  # one row at most


def json_cache(spark: SparkSession, path: str, key: str, order: str, schema: str) -> DataFrame:
    """The last row (by order) of each key of JSON lines; lines cut short and lines without the key are left out."""
    lines = spark.read.json(path, schema=f"{schema}, _corrupt string", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    names = [f for f in lines.columns if f != "_corrupt"]
    whole = lines.where(F.col("_corrupt").isNull() & F.col(key).isNotNull()).select(*names)
    return whole.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("row")).select("row.*")


def deck(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """JSON lines; a repeated id is an error."""
    cards = spark.read.json(path, schema=schema)
    again = cards.groupBy(key).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"repeated id {again[0][0]!r}")
    return cards


def log_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a folder, with file, block and place; ordered by these three they stand as in their files.

    block is where in the file the task's part begins, and place grows with the lines of a part.
    """
    return spark.read.json(path, schema=schema).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def titles(spark: SparkSession, path: str) -> DataFrame:
    """(word): the last tab-separated field of each line but the header, if it is written in small letters a to z."""
    last = F.substring_index("value", "\t", -1)
    lines = spark.read.csv(path, header=True, schema="value string", sep="\u0001", quote="")
    return lines.select(last.alias("word")).where(F.col("word").rlike(r"^[a-z]+\z")).distinct()


def tiers(spark: SparkSession, path: str, pattern: str = r"\.(\d+)$") -> DataFrame:
    """(word, tier): plain words of Latin-1 lists whose names end in their tier; a word has the smallest."""
    tier = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("int").alias("tier")
    lines = spark.read.csv(path, schema="value string", encoding="ISO-8859-1", sep="\u0001", quote="").select("value", tier)
    plain = lines.select(normalise(F.trim("value")).alias("word"), "tier").where("word is not null and tier is not null")
    return plain.groupBy("word").agg(F.min("tier").alias("tier"))


#: Bytes of an archive and of one of its members at most.
MOST_ARCHIVE, MOST_MEMBER = 1 << 30, 256 << 20


def archive_lines(spark: SparkSession, path: str, pattern: str, encoding: str = "latin-1", most: int = MOST_MEMBER) -> DataFrame:
    """(archive, member, value): the lines of the members of tar archives (plain, gz, bz2, xz) whose whole name the pattern matches.

    An archive is read by one task, a member at a time; a member of more than
    `most` bytes is an error, as is an archive beyond MOST_ARCHIVE.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import re
        import tarfile

        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                with tarfile.open(fileobj=io.BytesIO(content.as_buffer()), mode="r:*") as tar:
                    for member in tar:
                        if not member.isfile() or not re.fullmatch(pattern, member.name):
                            continue
                        if member.size > most:
                            raise ValueError(f"{member.name} has {member.size} bytes, more than {most}")
                        with tar.extractfile(member) as held:
                            text = io.TextIOWrapper(held, encoding=encoding, newline=None)
                            while rows := text.readlines(1 << 20):
                                value = [x.rstrip("\n") for x in rows]
                                yield pa.RecordBatch.from_pydict({"archive": [archive] * len(value), "member": [member.name] * len(value), "value": value})

    whole = spark.read.format("binaryFile").load(path)
    large = whole.where(F.col("length") > MOST_ARCHIVE).select("path").limit(1).collect()
    if large:
        raise ValueError(f"{large[0]['path']} is larger than {MOST_ARCHIVE} bytes")
    return whole.select("path", "content").mapInArrow(lines, "archive string, member string, value string")


def archive_tiers(spark: SparkSession, path: str, pattern: str = r".*-words\.\d+", sizes: tuple[int, ...] = ()) -> DataFrame:
    """(word, tier): plain words of an archive's lists whose names end in their tier, one of sizes if given; a word has the smallest."""
    tier = F.regexp_extract("member", r"\.(\d+)$", 1).try_cast("int")
    found = archive_lines(spark, path, pattern).select(normalise(F.trim("value")).alias("word"), tier.alias("tier")).where("word is not null and tier is not null")
    if sizes:
        found = found.where(F.col("tier").isin(*sizes))
    return found.groupBy("word").agg(F.min("tier").alias("tier"))


def yearly_counts(spark: SparkSession, path: str) -> DataFrame:
    """(w, year, match, volume) of lines word TAB year,match,volume TAB ...; parts that are no three numbers are left out."""
    return counts_of_lines(spark.read.text(path))


def counts_of_lines(lines: DataFrame) -> DataFrame:
    """yearly_counts() of lines (value)."""
    parts = F.split("value", "\t")
    each = lines.select(parts[0].alias("w"), F.explode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("t"))
    three = F.split("t", ",")
    cast = [F.get(three, F.lit(i)).try_cast("long").alias(n) for i, n in enumerate(("year", "match", "volume"))]
    return each.where(F.size(three) == 3).select("w", *cast).dropna()


def glossary(spark: SparkSession, path: str) -> DataFrame:
    """(word, definition): the first word of each line, and the rest, null if there is none."""
    line = F.regexp_replace("value", r"^\s+|\s+\z", "")
    rest = F.nullif(F.regexp_extract(line, r"^\S+\s+(.*)\z", 1), F.lit(""))
    return spark.read.text(path).where(line != "").select(F.regexp_extract(line, r"^\S+", 0).alias("word"), rest.alias("definition"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(word): lines in small letters; text after a # does not count, and lines with other characters are left out."""
    line = F.lower(F.trim(F.regexp_replace("value", "#.*", "")))
    return spark.read.text(path).select(line.alias("word")).where(F.col("word").rlike(r"^[a-z]+\z"))


def english_titles(spark: SparkSession, path: str) -> DataFrame:
    """(title): pages of a wiki dump (XML, bz2 or plain) that hold an English section."""
    pages = spark.read.format("xml").option("rowTag", "page").schema("title string, revision struct<text:string>").load(path)
    return pages.where(F.col("revision.text").rlike(r"(?m)^==\s*English\s*==\s*$")).select("title").distinct()


def _flags(value: Column, kind: Column) -> Column:
    """A text of flags as an array: single characters, pairs of them (long), or numbers (num)."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(value)), F.lit(2)), lambda i: F.substr(value, i, F.lit(2)))
    parts = F.when(kind == "num", F.split(value, ",")).when(kind == "long", pairs).otherwise(F.split(value, ""))
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda x: x != "")


def affix_rules(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """(flag, kind, strip, add, condition, cross, more) of an affix file, and how it writes flags: char, long or num.

    Lines are KIND flag strip add[/more] condition; a head line KIND flag cross
    number comes before the rules of a flag.  0 stands for nothing; more holds
    the flags that a made form has itself.  A rule without a condition fits all.
    """
    lines = spark.read.text(path).select(F.split(F.regexp_replace("value", r"^\s+|\s+\z", ""), r"\s+").alias("f"))
    form = lines.where(F.col("f")[0] == "FLAG").select(F.lower(F.get("f", F.lit(1)))).limit(1).collect()
    form = form[0][0] if form and form[0][0] in ("long", "num") else "char"
    own = lines.where(F.col("f")[0].isin("SFX", "PFX") & (F.size("f") >= 4))
    part = lambda i: F.get("f", F.lit(i))
    head = part(2).isin("Y", "N") & part(3).rlike(r"^\d+\z") & (F.size("f") == 4)
    cross = own.where(head).select(part(0).alias("k"), part(1).alias("flag"), (part(2) == "Y").alias("cross")).distinct()
    nothing = lambda c: F.when(c == "0", "").otherwise(c)
    rules = own.where(~head).select(part(0).alias("k"), part(1).alias("flag"), nothing(part(2)).alias("strip"), nothing(F.substring_index(part(3), "/", 1)).alias("add"), F.when(part(3).contains("/"), F.substring_index(part(3), "/", -1)).alias("more"), F.coalesce(part(4), F.lit(".")).alias("condition"))
    # a rule's number is that of the file, which does not grow with the data
    rules = rules.join(F.broadcast(cross), ["k", "flag"], "left")
    kind = F.when(F.col("k") == "SFX", "suffix").otherwise("prefix")
    return rules.select("flag", kind.alias("kind"), "strip", "add", "condition", F.coalesce("cross", F.lit(False)).alias("cross"), _flags(F.col("more"), F.lit(form)).alias("more")), form


def affix_stems(spark: SparkSession, path: str, form: str = "char") -> DataFrame:
    """(word, flags): the stems of a stem list, whose lines are word[/flags] after a head line with their number; flags is an array."""
    line = F.regexp_extract("value", r"^\s*(\S+)", 1)
    stems = spark.read.text(path).where(~F.col("value").rlike(r"^\s*\d*\s*\z")).select(F.regexp_replace(F.substring_index(line, "/", 1), r"\\", "").alias("word"), F.when(line.contains("/"), F.substring_index(line, "/", -1)).alias("f"))
    return stems.select("word", _flags(F.col("f"), F.lit(form)).alias("flags")).where("word <> ''")


def affix_forms(stems: DataFrame, rules: DataFrame) -> DataFrame:
    """(word): stems (word, flags) and what rules (flag, kind, strip, add, condition, cross and, if there are any, more) make of them.

    flags is an array, or a text of single characters.  kind is 'suffix' or
    'prefix'; a word takes a rule that it has the flag of and whose condition, a
    regular expression, its end or its beginning meets.  A form with a suffix
    takes the suffixes of the rule's own flags once more.  Prefixes are put before
    the words with one suffix as well, if both rules are to be crossed.  Rules
    are broadcast: their number is that of an affix file.
    """
    if "more" not in rules.columns:
        rules = rules.withColumn("more", F.array().cast("array<string>"))
    if dict(stems.dtypes)["flags"] == "string":
        stems = stems.withColumn("flags", F.filter(F.split("flags", ""), lambda x: x != ""))
    rules = F.broadcast(rules)

    def made(words: DataFrame, kind: str, flags: str = "flags") -> DataFrame:
        fits = words.select("word", "flags", F.explode(flags).alias("flag")).join(rules.where(F.col("kind") == kind), "flag")
        size = F.length("strip")
        if kind == "suffix":
            fits = fits.where(F.endswith("word", "strip") & F.expr("word rlike concat('(?:', condition, ')$')"))
            return fits.select(F.concat(F.left("word", F.length("word") - size), "add").alias("word"), "flags", "cross", "more")
        fits = fits.where(F.startswith("word", "strip") & F.expr("word rlike concat('^(?:', condition, ')')"))
        return fits.select(F.concat("add", F.substr("word", size + 1, F.length("word"))).alias("word"), "flags", "cross", "more")

    suffixed = made(stems.select("word", "flags"), "suffix")
    again = made(suffixed.select("word", "flags", "more"), "suffix", "more")
    crossed = made(suffixed.where("cross").select("word", "flags"), "prefix").where("cross")
    forms = [suffixed, again, made(stems.select("word", "flags"), "prefix"), crossed]
    out = stems.select("word")
    for f in forms:
        out = out.unionByName(f.select("word"))
    return out.distinct()


def first_seen(keys: DataFrame, column: str, order: str) -> DataFrame:
    """(column, code): distinct values numbered from 0 by where they are seen first; one row a value, so few."""
    first = keys.groupBy(column).agg(F.min(order).alias("__at"))
    return first.select(column, (F.row_number().over(Window.orderBy("__at", column)) - 1).alias("code"))
