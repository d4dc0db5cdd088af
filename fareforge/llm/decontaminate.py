"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders. Windows of placeholders and words of every document meet those of the
benchmark in a hash join; windows on one diagonal are a quoted span. Windows also meet by their plain lower-case tokens, whatever
they hold. A span is a leak if its windows of equal tokens are enough, or if it is long enough and its slots are consistent: equal values of the item stand for equal values of the document and different ones for different ones,
which holds for verbatim and for re-parameterised questions.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, only_result_stays

WINDOW = 8
#: A template window needs so many words that are no placeholders; a span so many windows, or most of a short item's.
LEAST_WORDS, LEAST_WINDOWS, MOST_OF_ITEM = 4, 6, 0.8
#: Benchmark windows are broadcast up to this size; above it both sides are shuffled by window.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 32
#: Marks of placeholders, and units that follow a number.
NUMBER, NAME, UNIT = "#", "@", "%"
MARK = "¤"
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres "
         "kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
         "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
         "weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent degree degrees kmh mph").split()
BETWEEN = f"[^\\p{{L}}\\p{{N}}{MARK}]+"
#: A capital that follows a word inside a sentence begins a name.
NAME_START = r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N},;] )"


def tokens(text: Column) -> Column:
    """Lower-case words and digit runs; names carry a mark."""
    plain = F.translate(F.coalesce(text, F.lit("")), MARK, "")
    return F.array_remove(F.split(F.lower(F.regexp_replace(plain, NAME_START, MARK)), BETWEEN), "")


def _is_number(t: Column) -> Column:
    return t < ":"  # only ASCII digits sort before it, as tokens hold letters and digits


def kinds(t: Column) -> Column:
    """The template of a token array: typed placeholders and words."""
    def kind(x: Column, i: Column) -> Column:
        unit = (i > 0) & x.isin(*UNITS) & _is_number(F.get(t, i - 1))
        return (F.when(_is_number(x), NUMBER).when(F.startswith(x, F.lit(MARK)), NAME).when(unit, UNIT).otherwise(x))
    return F.transform(t, kind)


def _windows(text: Column) -> Column:
    """(at, raw, h) of every window of a text: hashes of its tokens without marks and of its template."""
    def each(z: Column) -> Column:
        hashed = lambda c, i: F.xxhash64(*[z[c][i + k] for k in range(WINDOW)])
        roll = F.transform(F.sequence(F.lit(0), F.size(z["h"]) - WINDOW), lambda i: F.struct(
            i.alias("at"), hashed("raw", i).alias("raw"), hashed("h", i).alias("h")))
        return F.when(F.size(z["h"]) >= WINDOW, roll)
    return let(tokens(text), lambda t: let(F.struct(
        F.transform(t, lambda x: F.xxhash64(F.translate(x, MARK, ""))).alias("raw"),
        F.transform(kinds(t), lambda x: F.xxhash64(x)).alias("h")), each))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(h, item_id, place, literal, template, windows, templates): every window by its tokens and, with enough words of
    its own, by its template; one row where both are the same. The last two count the places of the item."""
    each = benchmark.where("item_id is not null").select(
        "item_id", _windows(F.col("text")).alias("w"), kinds(tokens(F.col("text"))).alias("k"))
    enough = F.size(F.filter(F.slice("k", F.col("at") + 1, WINDOW), lambda x: ~x.isin(NUMBER, NAME, UNIT))) >= LEAST_WORDS
    rows = each.select("item_id", "k", F.inline_outer("w")).where("at is not null").select(
        "item_id", F.col("at").alias("place"), F.inline(F.array(
            F.struct(F.col("raw").alias("h"), F.lit(True).alias("literal"), F.lit(False).alias("template")),
            F.struct(F.col("h"), F.lit(False).alias("literal"), enough.alias("template")))))
    rows = rows.where("literal or template").groupBy("h", "item_id", "place").agg(
        F.max("literal").alias("literal"), F.max("template").alias("template"))
    sizes = rows.groupBy("item_id").agg(F.count_distinct("place").alias("windows"),
                                        F.count_distinct(F.when(F.col("template"), F.col("place"))).alias("templates"))
    return rows.join(sizes, "item_id")


def slots(rows: DataFrame, key: str) -> DataFrame:
    """(key, at, kind, value) of every placeholder."""
    each = rows.select(key, let(tokens(F.col("text")), lambda t: F.arrays_zip(t.alias("value"), kinds(t).alias("kind"))).alias("z"))
    spread = each.select(key, F.posexplode_outer("z").alias("at", "z"))
    return spread.select(key, "at", "z.kind", "z.value").where(
        F.col("kind").isin(NUMBER, NAME, UNIT))


def spans(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, diagonal, n, lo, hi, literal): long enough runs of an item's windows in a document.

    `n` counts the windows of either kind, `lo` and `hi` are the ends of those that match by template, and `literal` says
    that the windows of equal tokens are enough by themselves.
    """
    known = materialize(item_windows(benchmark), "windows")
    small = known.count() * ROW_BYTES <= broadcast_bytes
    each = docs.select("doc_id", F.inline_outer(_windows(F.col("text"))))
    rolled = each.select("doc_id", "at", F.explode(F.when(F.col("raw") == F.col("h"), F.array("h")).otherwise(F.array("raw", "h"))).alias("h"))
    hits = rolled.join(F.broadcast(known) if small else known, "h")
    once = hits.groupBy("doc_id", "item_id", "windows", "templates", (F.col("at") - F.col("place")).alias("diagonal"), "place").agg(
        F.max("literal").alias("literal"), F.max("template").alias("template"))
    by_template = F.when(F.col("template"), F.col("place"))
    found = once.groupBy("doc_id", "item_id", "windows", "templates", "diagonal").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("literal").alias("equal"), F.count_if("template").alias("alike"),
        F.min(by_template).alias("lo"), (F.max(by_template) + WINDOW - 1).alias("hi"))
    long = lambda n, windows: (F.col(n) >= LEAST_WINDOWS) | ((F.col(n) > 0) & (F.col(n) >= MOST_OF_ITEM * F.col(windows)))
    return found.where(long("equal", "windows") | long("alike", "templates")).select(
        "doc_id", "item_id", "diagonal", "n", "lo", "hi", long("equal", "windows").alias("literal"))


def leaks(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_windows, items): one row per document that quotes an item; items are ids in order, comma-joined.

    Only spans over placeholders that are not literal quotes need the slot check; their documents alone are cut into
    tokens again.
    """
    found = materialize(spans(docs, benchmark, broadcast_bytes), "spans")
    held = materialize(slots(benchmark, "item_id").withColumnsRenamed({"at": "place", "value": "own"}), "slots")
    asked = found.where("not literal").join(held, "item_id").where(F.col("place").between(F.col("lo"), F.col("hi"))).select(
        "doc_id", "item_id", "diagonal", "kind", "own", (F.col("diagonal") + F.col("place")).alias("at"))
    asked = materialize(asked, "asked")
    ids = asked.select(F.col("doc_id").alias("_id")).distinct()
    mine = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    values = slots(mine, "doc_id").withColumnsRenamed({"doc_id": "_id", "at": "_at", "kind": "_kind"}).distinct()
    pairs = asked.join(values, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at")) & (F.col("kind") == F.col("_kind")))
    ways = pairs.select("doc_id", "item_id", "diagonal", "kind", "own", "value").distinct()
    pair = F.count(F.lit(1))
    broken = ways.groupBy("doc_id", "item_id", "diagonal").agg(
        pair.alias("p"), F.count_distinct("kind", "own").alias("a"), F.count_distinct("kind", "value").alias("b")).where("p > a or p > b")
    gone = broken.select(F.col("doc_id").alias("_id"), F.col("item_id").alias("_item"), F.col("diagonal").alias("_d"))
    kept = found.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("item_id") == F.col("_item"))
                      & (F.col("diagonal") == F.col("_d")), "left_anti")
    each = kept.groupBy("doc_id", "item_id").agg(F.max("n").alias("n"))
    return each.groupBy("doc_id").agg(F.sum("n").alias("n_windows"),
                                      F.array_join(F.sort_array(F.collect_set("item_id")), ",").alias("items"))


def check(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_windows, items) for every row of docs.

    Null and short texts quote nothing; items with fewer than WINDOW tokens are too common to tell and match nothing.
    Rows that share an id (null ids too) are one document for the verdict. Other columns are ignored; an empty table on
    either side gives no leaks.
    """
    found = materialize(leaks(docs, benchmark), "leaks").withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
        F.coalesce("items", F.lit("")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose document quotes no benchmark item, with all their columns.

    Rows that share an id are one document; every row without an id is one of its own, told by a row number.
    """
    whole = F.struct("*").alias("given")
    named = docs.where("doc_id is not null").select(whole, F.concat(F.lit("id "), F.col("doc_id").cast("string")).alias("_doc"))
    numbered = docs.where("doc_id is null").select(whole, F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")).alias("_doc"))
    every = named.unionByName(materialize(numbered, "unnamed"))
    found = only_result_stays(docs.sparkSession, lambda: leaks(
        every.select(F.col("_doc").alias("doc_id"), F.col("given.text").alias("text")), benchmark).select(F.col("doc_id").alias("_doc")), "leaks")
    return every.join(found, "_doc", "left_anti").select("given.*")
