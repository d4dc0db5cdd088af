"""License scans by diagonal voting.

All pairs of neighbouring words of every text meet the pairs of the license templates in one join. A hit votes for the
diagonal (its place in the text minus its place in the template); votes on one diagonal are consecutive template words,
and neighbouring diagonals are the same span with words put in or left out. A span counts where enough of its template
was seen within about the template's length.
"""
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let

#: Characters between words, and phrases that must stand word by word.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Notices that are known by their usual wording; a span of one may miss or add some words.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under the creative commons attribution sharealike 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
DRIFT, ENOUGH, LONGEST = 3, 0.6, 2
WHOLE_TEXT = -1


def lower_words(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), GAPS), "")


def _templates(notices: dict[str, str] = NOTICES) -> list[tuple[int, str, bool, list[str]]]:
    every = [(label, True, p.split()) for label, p in BASE.items()] + [(label, False, p.split()) for label, p in notices.items()]
    return [(i, label, base, w) for i, (label, base, w) in enumerate(every)]


def template_pairs(spark: SparkSession, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(h, template, place): one row per neighbouring words of a template; place -1 of template -1 stands for the text itself."""
    rows = ", ".join(f"({i}, {p}, '{w[p]}', '{w[p + 1]}')" for i, _, _, w in _templates(notices) for p in range(len(w) - 1))
    pairs = spark.sql(f"SELECT xxhash64(a, b) AS h, t AS template, p AS place FROM VALUES {rows} AS v(t, p, a, b)")
    return pairs.unionByName(spark.range(1).select(
        F.lit(0).cast("long").alias("h"), F.lit(WHOLE_TEXT).alias("template"), F.lit(WHOLE_TEXT).alias("place")))


def _events(text: Column) -> Column:
    """Struct of n_words and one event per word pair, led by one that stands for the text."""
    own = F.array(F.struct(F.lit(WHOLE_TEXT).alias("at"), F.lit(0).cast("long").alias("h")))

    def pairs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.struct(
            i.alias("at"), F.xxhash64(w[i], w[i + 1]).alias("h")))
        return F.when(F.size(w) >= 2, F.concat(own, each)).otherwise(own)

    return let(lower_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), pairs(w).alias("events")))


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs.

    `notices` may be whole license texts by label, lower-case words with blanks between; which of a template's places were
    seen is kept in words of 64 bits, as many as the longest template needs. Null, empty and one-word texts have no labels ('' and null places) and score 0. Rows that repeat an id are scanned
    each; other columns are ignored. An empty table gives an empty result. The score is the largest share of a template
    that a counted span shows, 1 for a base phrase.
    """
    each = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _events(F.col("text")).alias("e"))
    events = each.select("doc_id", "row", "e.n_words", F.inline_outer("e.events"))
    hits = events.join(F.broadcast(template_pairs(docs.sparkSession, notices)), "h")  # the templates' words, whatever the corpus
    of = {i: (label, base, len(w) - 1) for i, label, base, w in _templates(notices)}
    seen = [f"seen{k}" for k in range(-(-max(n for _, _, n in of.values()) // 64))]
    bit = lambda k: F.expr(f"bit_or(if(greatest(place, 0) div 64 = {k}, shiftleft(1L, cast(greatest(place, 0) % 64 as int)), 0L))").alias(seen[k])
    places = reduce(add, [F.bit_count(c) for c in seen])
    lines = hits.groupBy("doc_id", "row", "n_words", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        *map(bit, range(len(seen))), F.min("at").alias("lo"), F.max("at").alias("hi"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    breaks = F.col("diagonal") - F.coalesce(F.lag("diagonal").over(along), F.lit(-10**9)) > DRIFT
    chained = lines.withColumn("chain", F.sum(breaks.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    pick = lambda k: F.element_at(F.array(*[F.lit(v[k]) for v in of.values()]), F.greatest(F.col("template") + 1, F.lit(1)))
    known = F.col("template") >= 0
    exact = known & pick(1) & (places == pick(2))
    spans = chained.groupBy("doc_id", "row", "n_words", "template", "chain").agg(
        *[F.bit_or(c).alias(c) for c in seen], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.count_if(exact).alias("n"), F.min(F.when(exact, F.col("diagonal"))).alias("first"),
        F.max(F.when(exact, F.col("diagonal"))).alias("last"))
    share = places / pick(2)
    tight = F.col("hi") - F.col("lo") + 2 <= LONGEST * (pick(2) + 1)
    judged = spans.withColumn("share", F.when(F.col("n") > 0, 1.0).when(
        known & ~pick(1) & tight & (share >= ENOUGH), share))
    text = lambda found: F.array_join(F.sort_array(F.collect_set(found)), ",")
    return judged.groupBy("row", "doc_id", "n_words").agg(
        F.sum("n").alias("n_base"), F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"), text(F.when(F.col("n") > 0, pick(0))).alias("base_labels"),
        text(F.when(F.col("share").isNotNull(), pick(0))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score")).drop("row")


def scan_sql() -> str:
    """The same scan as SQL over a view `documents`."""
    rows = ", ".join(f"({i}, '{label}', {str(base).lower()}, {len(w) - 1}, {p}, '{w[p]}', '{w[p + 1]}')"
                     for i, label, base, w in _templates() for p in range(len(w) - 1))
    return f"""
WITH t(template, label, base, pairs, place, a, b) AS (VALUES {rows}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
pair AS (SELECT doc_id, i - 1 AS pos, words[i] AS a, words[i + 1] AS b FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM w)),
line AS (SELECT doc_id, template, label, base, pairs, pos - place AS diagonal, list(DISTINCT place) AS seen, min(pos) AS lo, max(pos) AS hi
  FROM pair JOIN t USING (a, b) GROUP BY ALL),
brk AS (SELECT *, (diagonal - coalesce(lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal), -1000000000) > {DRIFT})::INT AS cut FROM line),
chained AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS chain,
  base AND len(seen) = pairs AS exact FROM brk),
span AS (SELECT doc_id, template, label, base, pairs, chain, len(list_distinct(flatten(list(seen)))) / pairs AS share, min(lo) AS lo, max(hi) AS hi,
  count(*) FILTER (WHERE exact) AS n, min(diagonal) FILTER (WHERE exact) AS d0, max(diagonal) FILTER (WHERE exact) AS d1
  FROM chained GROUP BY doc_id, template, label, base, pairs, chain),
judged AS (SELECT *, CASE WHEN n > 0 THEN 1.0 WHEN NOT base AND hi - lo + 2 <= {LONGEST} * (pairs + 1) AND share >= {ENOUGH} THEN share END AS counted FROM span),
found AS (SELECT doc_id, sum(n)::BIGINT AS n_base, min(d0)::BIGINT AS first_word, max(d1)::BIGINT AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE n > 0) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE counted IS NOT NULL) AS labels, max(counted)::DOUBLE AS score FROM judged GROUP BY 1)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN found USING (doc_id)
"""
