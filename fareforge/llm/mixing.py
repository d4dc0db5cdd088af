"""Mixing sources to target weights by weighted fair queueing.

Every document of a shuffled source gets a virtual finish time: the words its source has sent once it is out, divided
by the source's target. Sources that are sent in the order of finish time advance in step, so one cut of the common
order at the budget leaves each of them within about a document of its target. Documents of a source that owes more
words than it has are sent again, a whole pass after the one before.
"""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running_before
from .common import BLANKS, materialize

#: The weights repeat over the sources in code-point order, null last.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Ranges per unit of finish time at each level of the cut.
RANGES = (64, 4096, 1 << 18)


def word_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return (F.size(parts) - F.when(parts[0] == "", 1).otherwise(0)
            - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, none above `most` times its source.

    One row per source goes in, so the windows without a key see as many rows as there are sources. With sources
    sorted by room per weight, the capped ones come first, and the rest share what those leave: the highest level that
    fits the room of the source where it begins.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = total.select("source", "source_size", weight.alias("weight"))
    ranked = ranked.withColumn("room", most * F.col("source_size") / F.col("weight"))
    w = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    share = ranked.withColumn("level", level)
    water = F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(everything)
    return share.select("source", "source_size", F.when(
        F.col("source_size") > 0, F.least(most * F.col("source_size").cast("double"), F.col("weight") * water))
        .otherwise(0.0).alias("target"))


def queue_key(doc_id: Column, size: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), size.cast("string")))


def mix_order(docs: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, seed: str = "mix") -> DataFrame:
    """The rows of docs once per possible sending, with source_size, target, pass and finish.

    `docs` has doc_id, source, size and the row number _row. The order inside a source is that of a salted digest of id and size; its first
    digits split a source, however large, into buckets for the running total.
    """
    key = queue_key(F.col("doc_id"), F.col("size"), seed)
    named = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    shuffled = docs.withColumns({"_key": key, "_source": named})
    queued = running_before(shuffled, ["_source"], ["_key", "doc_id", "size", "_row"], {"_sent": F.col("size")},
                            [F.substring("_key", 1, 2), F.substring("_key", 3, 2)]).drop("_source")
    targets = source_targets(docs, weights, most).withColumnRenamed("source", "_of")
    held = queued.join(targets, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    again = held.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    sent = F.col("pass") * F.col("source_size") + F.col("_sent") + F.col("size")
    return again.withColumn("finish", sent / F.col("target")).drop("_sent")


def cut_at_budget(order: DataFrame, budget: int) -> DataFrame:
    """The sendings that `budget` words pay for in the order of finish time.

    The order is cut into fixed ranges of finish time, coarse to fine. Every source sends its target per unit of time,
    so ranges of one width hold about equal numbers of words whatever the sources are; only the totals of ranges meet.
    """
    ranges = [F.floor(F.col("finish") * w) for w in RANGES]
    done = running_before(order.withColumn("_all", F.lit(1)), ["_all"], ["finish", "_key", "doc_id", "_row", "pass"],
                          {"_before": F.col("size")}, ranges)
    return done.where(F.col("_before") + F.col("size") <= budget).drop("_all", "_before")


def sendings(sized: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, seed: str = "mix") -> DataFrame:
    """What is sent of rows (doc_id, source, size, _row) until all their words are paid for."""
    budget = sized.agg(F.sum("size").alias("words")).first().words or 0
    return cut_at_budget(mix_order(sized, weights, most, seed), budget)


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs (doc_id, text, source).

    Null and blank texts have size 0 and nothing is taken from them; a source without words has target 0. Rows that
    repeat an id are documents of their own. Other columns are ignored. An empty table gives an empty result.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    sized = materialize(numbered.select("doc_id", "source", word_count(F.col("text")).alias("size"), "_row"), "sizes")
    taken = sendings(sized, weights, most, seed).groupBy("_row").agg(F.sum("size").alias("taken"))
    targets = source_targets(sized, weights, most).withColumnRenamed("source", "_of")
    return (sized.join(targets, F.col("source").eqNullSafe(F.col("_of")), "left").join(taken, "_row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_rows(docs: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, seed: str = "mix") -> DataFrame:
    """The rows of docs as the mix sends them: whole, in no order, those that the mix takes twice twice.

    The columns are those of docs. Rows that share an id, and rows without one, are each taken as often as the mix takes
    that row. The input is written once with sizes and row numbers. A source sends in one order, pass after pass, so what
    the mix takes of a pass ends with one row; a table of these rows, one row per source, tells every other row by its own
    place how often it is sent, and the texts stay where they are.
    """
    numbered = materialize(docs.select(F.struct("*").alias("given"), word_count(F.col("text")).alias("_size"),
                                       F.monotonically_increasing_id().alias("_row")), "numbered")
    sized = numbered.select("given.doc_id", "given.source", F.col("_size").alias("size"), "_row")
    ends = sendings(sized, weights, most, seed).groupBy("source", "pass").agg(
        F.max(F.struct("_key", "doc_id", "size", "_row")).alias("end"))
    ends = materialize(ends.groupBy(F.col("source").alias("_of")).agg(F.collect_list("end").alias("_ends")), "ends")
    doc_id = F.col("given.doc_id")
    place = F.struct(queue_key(doc_id, F.col("_size"), seed).alias("_key"), doc_id.alias("doc_id"), F.col("_size").alias("size"), "_row")
    sent = numbered.where("_size > 0").join(ends, F.col("given.source").eqNullSafe(F.col("_of"))).withColumn("_place", place)
    times = F.explode(F.filter("_ends", lambda end: F.col("_place") <= end))
    return sent.select("given", times.alias("_pass")).select("given.*")
