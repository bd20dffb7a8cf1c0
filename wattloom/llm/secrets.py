"""Secrets in texts, and weak candidates that count only beside their complementary parts.

Strong kinds stand alone: assignments to a secret's name, cloud access identifiers, long hexadecimal strings. Weak
kinds are common in clean text: addresses, names of accounts, forty-character keys. A weak span is reported when the parts that
make it usable lie within ``SCOPE`` code points: parts are joined by intervals, on the text's scope and its neighbours, so a
span meets only what is near it, however long the text or however many spans it holds.

Everything is column expressions. Positions come from the lengths of the matches and of what lies between. Running sums and masked
texts are made in blocks of ``BLOCK`` matches, so the work of a text grows with its length and matches, not with their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

SCOPE = 200
BLOCK = 128

# Patterns of the strong kinds, in the order in which spans with one start are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

ENDPOINT = r"""(?:https?|ftp|ssh|postgres|mysql|redis|amqp|mongodb)://[^\x20\x09-\x0D"'<>]+"""
ACCOUNT = r"""((?i:user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+)"""
KEY40 = r"[A-Za-z0-9/+]{40,}"

KINDS = ["assign", "access", "hex", "endpoint", "account", "key"]
# What must be near a weak span: one of each group.
NEEDS = {"endpoint": [["access", "account"], ["assign", "hex", "key"]], "account": [["assign", "hex", "key"], ["endpoint"]], "key": [["access", "account"]]}


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is read."""
    return F.transform(F.array(value), use)[0]


def _block(rows: Column, n: Column) -> Column:
    return F.slice(rows, n * BLOCK + 1, F.lit(BLOCK))


def _blocks(rows: Column) -> Column:
    """Numbers of the blocks of an array that is not empty."""
    return F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))


def found(text: Column, kind: str, pattern: str, group: int = 0, least: int = 1, most: int | None = None) -> Column:
    """Leftmost matches that do not overlap, as structs ``start``, ``rank``, ``end``, ``kind`` (code points, end exclusive).

    Matches whose ``group`` is shorter than ``least`` or longer than ``most`` are dropped; they still take their place.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    sized = F.arrays_zip(F.transform(between, F.length).alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(value, F.length).alias("value"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def step(acc, r):
        start = acc["at"] + r["gap"]
        fits = (r["value"] >= least) if most is None else (r["value"] >= least) & (r["value"] <= most)
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + r["size"]).alias("end"), F.lit(kind).alias("kind"))
        return F.struct((start + r["size"]).alias("at"), F.when(fits, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def spans(rows):
        def block(acc, n):
            done = F.aggregate(_block(rows, n), F.struct(acc["at"].alias("at"), none.alias("out")), step)
            return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,rank:int,end:int,kind:string>>>").alias("out"))
        return F.aggregate(_blocks(rows), zero, block, lambda acc: F.flatten(acc["out"]))

    # What lies behind the last match has no size.
    return F.when(text.rlike(pattern), _bound(F.filter(sized, lambda r: r["size"].isNotNull()), spans)).otherwise(none)


def strong(text: Column) -> Column:
    return F.concat(found(text, "assign", ASSIGN, 2, 8), found(text, "access", ACCESS), found(text, "hex", HEX))


def weak(text: Column) -> Column:
    return F.concat(found(text, "endpoint", ENDPOINT), found(text, "account", ACCOUNT, 2, 3), found(text, "key", KEY40, 0, 40, 40))


def linked(parts: DataFrame) -> DataFrame:
    """``row``, ``extra``: weak spans with their complementary parts in scope, of rows with ``base`` and ``weak`` spans."""
    spans = stored(parts.filter(F.size("weak") > 0).select("row", F.explode(F.concat("base", "weak")).alias("s")).select("row", "s.*"), "spans")
    # A part within SCOPE of a span starts in a scope that the span, widened by SCOPE, touches, or reaches into one.
    width = 2 * SCOPE
    reach = lambda a, b: F.sequence((a / width).cast("int"), (b / width).cast("int"))
    asks = spans.filter(F.col("kind").isin(*NEEDS)).select("row", "start", "rank", "end", "kind", F.explode(reach(F.greatest(F.lit(0), F.col("start") - SCOPE), F.col("end") + SCOPE)).alias("scope"))
    gives = spans.select(F.col("row").alias("row2"), F.col("start").alias("s2"), F.col("end").alias("e2"), F.col("kind").alias("k2"), F.explode(reach(F.col("start"), F.col("end"))).alias("scope2"))
    near = (F.col("s2") <= F.col("end") + SCOPE) & (F.col("e2") >= F.col("start") - SCOPE)
    # An account name inside an address, or a key inside an assignment, is no part of its own.
    apart = (F.col("s2") >= F.col("end")) | (F.col("e2") <= F.col("start"))
    met = asks.join(gives, (F.col("row") == F.col("row2")) & (F.col("scope") == F.col("scope2")) & near & apart)
    kinds = met.groupBy("row", "start", "rank", "end", "kind").agg(F.collect_set("k2").alias("near"))
    whole = F.lit(False)
    for kind, groups in NEEDS.items():
        ok = F.col("kind") == kind
        for g in groups:
            ok = ok & F.arrays_overlap("near", F.array(*[F.lit(x) for x in g]))
        whole = whole | ok
    return kinds.filter(whole).groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end", "kind")).alias("extra"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def with_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of every row, ``base`` and ``extra`` spans. A NULL text is an empty one; texts are read whole."""
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select(*keep, F.monotonically_increasing_id().alias("row"), strong(text).alias("base"), weak(text).alias("weak"))
    scanned = stored(scanned, "scanned")
    extra = linked(scanned.select("row", "base", "weak"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return scanned.join(extra, "row", "left").select(*keep, "base", F.coalesce("extra", none).alias("extra"))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` of every row, repeated ones included."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "extra")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by the name of its first kind."""
    def step(part, base):
        def one(acc, s):
            gap = F.substring(part, acc["at"] - base + 1, s["start"] - acc["at"])
            more = F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

        return one

    def whole(rows):
        def block(acc, n):
            def cut(some):
                # Text from where the block before ended to the end of this block's spans.
                length = F.greatest(F.lit(0), F.array_max(F.transform(some, lambda s: s["end"])) - acc["at"])
                zero = F.struct(acc["at"].alias("at"), F.lit("").alias("out"))
                done = _bound(F.substring(text, acc["at"] + 1, length), lambda part: F.aggregate(some, zero, step(part, acc["at"])))
                return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

            return _bound(_block(rows, n), cut)

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(_blocks(rows), zero, block, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))

    return F.when(F.size(spans) > 0, _bound(F.array_sort(spans), whole)).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with secrets masked in ``text`` (NULL stays NULL); ``n_chars`` follows where it is there.

    Only rows with weak candidates are joined; the texts of the others are not shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    cols = docs.columns
    marks = docs.select(*cols, strong(text).alias("__base"), weak(text).alias("__weak"))
    alone = marks.filter(F.size("__weak") == 0).withColumn("__spans", F.col("__base"))
    rest = stored(marks.filter(F.size("__weak") > 0).withColumn("__row", F.monotonically_increasing_id()), "weak")
    extra = linked(rest.select(F.col("__row").alias("row"), F.col("__base").alias("base"), F.col("__weak").alias("weak")))
    extra = extra.withColumnsRenamed({"row": "__row", "extra": "__extra"})
    joined = rest.join(extra, "__row", "left").withColumn("__spans", F.when(F.col("__extra").isNotNull(), F.concat("__base", "__extra")).otherwise(F.col("__base")))
    both = alone.select(*cols, "__spans").union(joined.select(*cols, "__spans"))
    out = both.withColumn("text", F.when(F.col("text").isNotNull(), masked(F.col("text"), F.col("__spans"))))
    if "n_chars" in cols:
        size = F.when(F.size("__spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(*cols)


@query("op5_secret_scans")
def op5(spark, folder):
    return secrets(table(spark, folder, "documents"))
