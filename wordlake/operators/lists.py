"""Word lists: promotion, demotion, ledgers, reconciliation, guarded overwrites."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class RefusedError(Exception):
    """A change that would break a list is not made."""


def promote(valid: DataFrame, invalid: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The batch's words join the valid list (once each) and leave the invalid one."""
    batch = batch.select("word").distinct()
    return valid.select("word").unionByName(batch.join(valid, "word", "left_anti")), invalid.select("word").join(batch, "word", "left_anti")


def demote(valid: DataFrame, invalid: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All or nothing: every row must be reversible and its word on the valid list."""
    missing = ledger.join(valid, "word", "left_anti").count()
    fixed = ledger.where("reversible <> 'yes' or reversible is null").count()
    if missing or fixed:
        raise RefusedError(f"{missing} words are not on the valid list, {fixed} rows are not reversible")
    out = ledger.select("word").distinct()
    return valid.join(out, "word", "left_anti"), invalid.select("word").union(out).distinct()


def apply_ledger(valid: DataFrame, invalid: DataFrame, ledger: DataFrame) -> DataFrame:
    """Removes the ledger's words from the invalid list; an unknown action or a word absent from the valid list refuses all, an absent one is no change."""
    unknown = ledger.where("action <> 'remove_from_invalid_list' or action is null").count()
    strange = ledger.join(valid, "word", "left_anti").count()
    if unknown or strange:
        raise RefusedError(f"{unknown} unknown actions, {strange} words not on the valid list")
    return invalid.join(ledger, "word", "left_anti")


def reconcile(before: DataFrame, after: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """Words whose change the ledger does not explain: (word, problem)."""
    flag = lambda df, name: df.select("word", F.lit(name).alias("side"))
    sides = flag(before, "before").union(flag(after, "after")).union(flag(removed, "removed")).union(flag(added, "added"))
    has = lambda name: F.max(F.col("side") == name).alias(name)
    state = sides.groupBy("word").agg(*[has(n) for n in ("before", "after", "removed", "added")])
    problem = F.when(F.col("before") & ~F.col("after") & ~F.col("removed"), "lost").when(~F.col("before") & F.col("after") & ~F.col("added"), "unexplained").when(F.col("removed") & F.col("after"), "not removed").when(F.col("added") & ~F.col("after"), "not added")
    return state.select("word", problem.alias("problem")).where("problem is not null")


def due(checked: DataFrame, as_of: str, days: int = 180, limit: int = 200) -> DataFrame:
    """The words (word, checked) to look up next: those never checked, then those checked longest ago, but none within the last days."""
    last = F.date_sub(F.lit(as_of).cast("date"), days)
    return checked.where(F.col("checked").isNull() | (F.col("checked") <= last)).orderBy(F.coalesce(F.col("checked").cast("string"), F.lit("")), "word").limit(limit)


def evict(checked: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """What of the record of checks is still within its days."""
    return checked.where(F.col("checked") > F.date_sub(F.lit(as_of).cast("date"), days))


def form_ledger(entries: DataFrame, frame: DataFrame) -> DataFrame:
    """(word, action, category, listed): entries against the form rule are deleted, and their plain forms, where well-formed and new, are added."""
    word = F.col("word")
    bad = entries.where(~word.rlike(r"^[a-z]+\z")).withColumn("plain", F.translate(F.regexp_replace(word, "[^a-zñéáíóú]", ""), "ñéáíóú", "neaiou"))
    category = F.when(word.startswith("-") | word.endswith("-"), "fragment").when(F.octet_length(word) != F.length(word), "accented").otherwise("compound")
    found = bad.join(frame.select(word.alias("plain"), F.lit(True).alias("known")), "plain", "left")
    deleted = found.select("word", F.lit("delete_malformed").alias("action"), category.alias("category"), F.coalesce("known", F.lit(False)).alias("listed"), "plain")
    added = deleted.where(~F.col("listed") & F.col("plain").rlike(r"^[a-z]+\z")).select(F.col("plain").alias("word")).distinct()
    return deleted.drop("plain").unionByName(added.select("word", F.lit("add_candidate").alias("action"), F.lit("plain-form").alias("category"), F.lit(False).alias("listed")))


def form_problems(ledger: DataFrame, frame: DataFrame) -> DataFrame:
    """(word, problem) of every row that must not be applied; a ledger is applied only where there is none."""
    known = ledger.join(frame.select("word", F.lit(True).alias("known")), "word", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    action, good = F.col("action"), F.col("word").rlike(r"^[a-z]+\z")
    problem = (
        F.when(~F.coalesce(action.isin("delete_malformed", "add_candidate"), F.lit(False)), "unknown action")
        .when((action == "delete_malformed") & good, "well-formed").when((action == "delete_malformed") & ~F.col("known"), "not present")
        .when((action == "add_candidate") & ~good, "malformed").when((action == "add_candidate") & F.col("known"), "already present")
    )
    return known.select("word", problem.alias("problem")).where("problem is not null")


def apply_form_ledger(frame: DataFrame, ledger: DataFrame) -> DataFrame:
    """The frame after the ledger's deletions and additions; a single bad row refuses all."""
    bad = form_problems(ledger, frame).count()
    if bad:
        raise RefusedError(f"{bad} ledger rows are unsafe")
    gone, new = (ledger.where(F.col("action") == a).select("word").distinct() for a in ("delete_malformed", "add_candidate"))
    return frame.select("word").join(gone, "word", "left_anti").unionByName(new)


def guarded_overwrite(new: DataFrame, path: str, loaded: int, least: float = 0.5) -> int:
    """Writes the list sorted, unless it has no rows or under the given share of those loaded.

    The list is written beside its place and then swapped in, so that a failed
    write loses nothing and new may be derived from the list itself.
    """
    context = new.sparkSession.sparkContext
    at = lambda name: context._jvm.org.apache.hadoop.fs.Path(name)
    final, draft, old = (at(f"{path.rstrip('/')}{end}") for end in ("", f".new-{uuid.uuid4().hex}", f".old-{uuid.uuid4().hex}"))
    files = final.getFileSystem(context._jsc.hadoopConfiguration())
    new.select("word").sort("word").write.text(draft.toString())
    rows = new.sparkSession.read.text(draft.toString()).count()
    if rows == 0 or rows < least * loaded:
        files.delete(draft, True)
        raise RefusedError(f"{rows} rows would replace {loaded}")
    if files.exists(final):
        files.rename(final, old)
    files.rename(draft, final)
    files.delete(old, True)
    return rows


def numbered_log(log: DataFrame) -> DataFrame:
    """A log (day, n), one row a day, with update numbers from 1 in the order of days."""
    return log.withColumn("update_number", F.row_number().over(Window.orderBy("day")))


def upsert_log(log: DataFrame, new: DataFrame) -> DataFrame:
    """log (day, n, update_number) with the rows of new (day, n): known days keep their number, further ones are numbered on in the order of days."""
    kept = log.join(new.withColumnRenamed("n", "__n"), "day", "left").select("day", F.coalesce("__n", "n").alias("n"), "update_number")
    last = log.agg(F.coalesce(F.max("update_number"), F.lit(0)).alias("__last"))  # one row
    more = numbered_log(new.join(log, "day", "left_anti")).join(F.broadcast(last), F.lit(True))
    return kept.unionByName(more.select("day", "n", (F.col("update_number") + F.col("__last")).alias("update_number")))


def promoted_dictionary(dictionary: DataFrame, batch: DataFrame, as_of: str) -> DataFrame:
    """dictionary (word, source, added_date, validation_status) with the words of batch (the same columns; all but word may be null).

    Words are written in small letters without blanks around them.  A word that is
    there stays as it is, so a second promotion changes nothing; a new one without
    metadata gets the defaults.  Of a word's rows in batch one with metadata counts.
    """
    word = F.lower(F.regexp_replace("word", r"^\s+|\s+\z", "")).alias("word")
    meta = ("source", "added_date", "validation_status")
    given = F.struct(*[F.col(c).isNull().alias(f"no_{c}") for c in meta], *meta)
    new = batch.select(word, *meta).where("word <> ''").groupBy("word").agg(F.min(given).alias("m"))
    new = new.join(dictionary.select("word"), "word", "left_anti")
    bare = F.coalesce(*[F.col(f"m.{c}") for c in meta]).isNull()
    default = {"source": "phase3_update", "added_date": as_of, "validation_status": "valid"}
    return dictionary.select("word", *meta).unionByName(new.select("word", *[F.when(bare, F.lit(default[c])).otherwise(F.col(f"m.{c}")).alias(c) for c in meta]))


def never_consulted(statuses: DataFrame, sources: list[str]) -> DataFrame:
    """(source, answered, asked): sources of which no row of statuses has an answer, so that a run was partial."""
    said = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c) != "not_consulted"))
    sums = statuses.agg(F.count("*").alias("asked"), *[said(c).alias(c) for c in sources])  # one row
    each = sums.select("asked", F.explode(F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).alias("answered")) for c in sources])).alias("x"))
    return each.select("x.source", "x.answered", "asked").where("answered = 0 and asked > 0")
