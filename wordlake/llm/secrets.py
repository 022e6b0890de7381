"""Secret scanning with linking of multipart credentials.

Certain spans (keyed assignments, access keys, long hex runs) are always
reported.  Weak candidates (identifiers, e-mail addresses as account names, bare
high-entropy strings, endpoints) are reported only where the parts that complete a credential stand within the
same scope, found by an interval join over scope windows.  All of it is native
DataFrame work in one scan of the table; each kind has its own expression, and
the work grows with the matches, however many a text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_IDS, ROW, columns_of, numbered, save

#: Certain kinds: (kind, expression, group whose length counts, least length).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Weak kinds: (kind, expression, part of a credential).
WEAK = (
    ("id", r"""(?i:client|account|user|tenant)[_-]?(?i:id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{4,}""", "id"),
    ("bare", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{24,}={0,2}", "secret"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "id"),
    ("endpoint", r"""(?i:https?)://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s"'<>]*)?""", "endpoint"),
)
#: What every match of a kind holds; texts without it are not searched for the kind.
HOLDS = {"access": "AKIA", "email": "@", "endpoint": "://"}
#: The part of a credential that a certain kind stands for.
PART = {"assign": "secret", "access": "id", "hex": "secret", "id": "id", "email": "id", "bare": "secret", "endpoint": "endpoint"}
#: A weak candidate of a part is reported if all of these other parts are in scope.
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
#: Code points within which the starts of a credential's parts stand.
SCOPE = 200
KINDS = [k for k, *_ in BASE] + [k for k, *_ in WEAK]
SPAN_TYPE = "struct<start:bigint,order:int,end:bigint,kind:string>"
SPAN = f"array<{SPAN_TYPE}>"
#: Code points of a piece of text that is masked at a time.
PIECE = 2000


#: Lengths of what stands before a match, of the match, and of what counts of it; the last entry is the rest of the text.
LENGTHS = "array<struct<gap:int,match:int,value:int>>"


def _lengths(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """The lengths of the gaps and matches of pattern in text, leftmost first without overlaps, in code points; null without a match.

    The pieces between matches give the positions that the matches alone lack.
    Each expression runs once over the text, whatever the number of matches.
    """
    each = lambda found: F.transform(found, lambda x: F.length(x))
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    there = text.contains(HOLDS[kind]) & text.rlike(pattern) if kind in HOLDS else text.rlike(pattern)
    return F.when(there, F.arrays_zip(each(pieces).alias("gap"), each(matches).alias("match"), each(value).alias("value")).cast(LENGTHS))


def _spans(scanned: DataFrame, kinds: list[tuple[str, int]]) -> DataFrame:
    """(uid, span, part) of the kinds (name, least length), from their lengths: places are running sums over a text's pieces."""
    rows = None
    for kind, least in kinds:
        own = scanned.where(F.col(f"k_{kind}").isNotNull()).select("uid", F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind"), F.lit(least).alias("least"), F.posexplode(f"k_{kind}").alias("at", "x"))
        rows = own if rows is None else rows.unionByName(own)
    upto = Window.partitionBy("uid", "order").orderBy("at")
    size = F.coalesce(F.col("x.match"), F.lit(0))
    placed = rows.withColumn("end", F.sum((F.col("x.gap") + size).cast("long")).over(upto)).where(F.col("x.match").isNotNull() & (F.col("x.value") >= F.col("least")))
    part = F.create_map(*[F.lit(x) for pair in PART.items() for x in pair])
    return placed.select("uid", F.struct((F.col("end") - F.col("x.match")).alias("start"), "order", "end", "kind").cast(SPAN_TYPE).alias("span"), part[F.col("kind")].alias("part"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, row_col: str | None = None) -> DataFrame:
    """One row per row of docs: uid, doc_id, base and found (arrays of span structs), ordered by start, then kind.

    base has the certain spans, found those and the linked weak ones.  A null
    text counts as empty.  Rows are told apart by a number of their own (that of
    row_col, if given), so repeated rows and null ids stay as they are.  Other
    columns are not read.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    uid, keys = (F.col("uid"), ["uid"]) if row_col else (F.monotonically_increasing_id().alias("uid"), [])
    source = columns_of(docs, id_col, text_col, *([row_col] if row_col else [])).toDF("doc_id", "text", *keys)
    found = [_lengths(text, kind, pattern, group).alias(f"k_{kind}") for kind, pattern, group, _ in BASE] + [_lengths(text, kind, pattern).alias(f"k_{kind}") for kind, pattern, _ in WEAK]
    scanned = save(source.select(uid, "doc_id", *found))
    certain = save(_spans(scanned, [(kind, least) for kind, _, _, least in BASE]))

    # a weak candidate inside a certain span is that span already
    span = F.struct(*[F.col(f"span.{c}") for c in ("start", "order", "end", "kind")])
    windows = lambda df: df.withColumn("window", F.floor(F.col("span.start") / scope))
    loose = windows(save(_spans(scanned, [(kind, 0) for kind, *_ in WEAK])))
    known = certain.select("uid", F.col("span.start").alias("b0"), F.col("span.end").alias("b1"), F.explode(F.sequence(F.floor(F.col("span.start") / scope), F.floor(F.col("span.end") / scope))).alias("window"))
    edge = F.explode(F.array_distinct(F.array(F.floor(F.col("span.start") / scope), F.floor((F.col("span.end") - 1) / scope)))).alias("edge")
    inside = loose.select("uid", "span", edge).join(known.withColumnRenamed("window", "edge"), ["uid", "edge"]).where("b0 <= span.start and span.end <= b1").select("uid", "span").distinct()
    loose = loose.join(inside, ["uid", "span"], "left_anti")

    every = certain.unionByName(loose.drop("window"))
    near = every.select("uid", "part", F.col("span.start").alias("at"), F.explode(F.sequence(F.floor(F.col("span.start") / scope) - 1, F.floor(F.col("span.start") / scope) + 1)).alias("window"))
    linked = None
    for part, needs in NEEDS.items():
        mine = loose.where(F.col("part") == part)
        for need in needs:
            other = near.where(F.col("part") == need).select("uid", "window", "at")
            mine = mine.alias("m").join(other.alias("o"), (F.col("m.uid") == F.col("o.uid")) & (F.col("m.window") == F.col("o.window")) & F.col("o.at").between(F.col("m.span.start") - scope, F.col("m.span.start") + scope), "left_semi")
        linked = mine if linked is None else linked.unionByName(mine)
    gathered = lambda rows, name: rows.groupBy("uid").agg(F.collect_list(span).alias(name))
    both = gathered(certain, "base").join(gathered(linked, "more"), "uid", "full")
    none = F.expr(f"cast(array() as {SPAN})")
    base, more = (F.coalesce(c, none) for c in ("base", "more"))
    return scanned.select("uid", "doc_id").join(both, "uid", "left").select("uid", "doc_id", F.array_sort(base).alias("base"), F.array_sort(F.concat(base, more)).alias("found"))


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the certain kinds, base_sha256 and spans, from find_secrets()."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k, *_ in BASE], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """docs with every found span of text replaced by mask (overlapping spans by one), all columns; n_chars follows the text.

    Rows are told apart by a number of their own, so repeated and null ids are
    masked each by itself.  A null text stays null; all rows stay.
    """
    table = numbered(docs)
    spans = save(find_secrets(table, row_col=ROW).where(F.size("found") > 0).select(F.col("uid").alias(ROW), F.col("found").alias("__spans")))
    # only the rows with spans are shuffled; their numbers are broadcast while they are few
    ids = spans.select(ROW)
    ids = F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    own, rest = table.join(ids, ROW, "left_semi"), table.join(ids, ROW, "left_anti")
    # overlapping spans are one; a new one begins where no earlier span reaches
    order = Window.partitionBy(ROW).orderBy("span")
    each = spans.select(ROW, F.explode("__spans").alias("span")).distinct()
    each = each.withColumn("upto", F.max("span.end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    each = each.withColumn("number", F.sum((F.coalesce(F.col("upto"), F.lit(-1)) <= F.col("span.start")).cast("int")).over(order))
    covers = each.groupBy(ROW, "number").agg(F.min("span.start").alias("a"), F.max("span.end").alias("b"))
    # texts are cut into pieces, so that a place is found in a piece and not in the whole text for each span
    texts = own.select(ROW, F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("piece", "own"))
    parts = covers.select(ROW, "a", "b", F.explode(F.sequence(F.floor(F.col("a") / PIECE).cast("int"), F.floor((F.greatest("b", F.col("a") + 1) - 1) / PIECE).cast("int"))).alias("piece"))
    inside = parts.groupBy(ROW, "piece").agg(F.sort_array(F.collect_list(F.struct((F.col("a") - F.col("piece") * PIECE).cast("int").alias("a"), (F.col("b") - F.col("piece") * PIECE).cast("int").alias("b")))).alias("cuts"))
    # what stays before each cut, the mask where a cut begins, and what stays after the last
    between = lambda a, b: F.when(b > a, F.substr("own", a + 1, b - a)).otherwise("")
    kept = F.transform("cuts", lambda c, i: F.concat(between(F.greatest(F.lit(0), F.coalesce(F.get("cuts", i - 1)["b"], F.lit(0))), c["a"]), F.when(c["a"] >= 0, mask).otherwise("")))
    masked = F.when(F.col("cuts").isNull(), F.col("own")).otherwise(F.concat(F.array_join(kept, ""), between(F.element_at("cuts", -1)["b"], F.length("own"))))
    pieces = texts.join(inside, [ROW, "piece"], "left").select(ROW, F.struct("piece", masked.alias("text")).alias("p"))
    done = pieces.groupBy(ROW).agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["text"]), "").alias("__text"))
    joined = own.join(done, ROW, "left").withColumn("text", F.coalesce("__text", "text")).drop("__text").unionByName(rest)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
