"""Repeated and missing ids: rows stay rows through the stages of the pipeline."""
import collections

from fareforge.llm import decontaminate, jaccard, mixing

ROWS = [(None, f"text number {i} without an id", "a") for i in range(5)] + [(7, f"again {i} and on", "a") for i in range(3)] + [
    (i, f"one of its own {i}", "a") for i in range(20, 30)] + [(1, None, "a"), (None, " ", "a")]


def test_mix_sends_each_row_by_its_own_takes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    got = collections.Counter((r.doc_id, r.text) for r in mixing.mixed_rows(docs).collect())
    assert got == collections.Counter(r[:2] for r in ROWS if (r[1] or "").strip())


def test_mix_keeps_to_budget_and_passes(spark):
    rows = [(None if i % 2 else 3, f"word {i} " * (1 + i % 4), "abc"[i % 20 % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = collections.Counter(r.text for r in mixing.mixed_rows(docs).collect())
    assert max(got.values()) <= 3
    assert sum(len(t.split()) * k for t, k in got.items()) <= sum(len(r[1].split()) for r in rows)


def test_one_leak_takes_one_row_without_id(spark):
    item = "the farmer walks along the green road until the small house by the lake comes into view again"
    rows = [(None, item), (None, "a clean text"), (None, None), (4, item), (4, "same id as a leak"), (5, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = collections.Counter(tuple(r) for r in decontaminate.clean(docs, bench).collect())
    assert got == collections.Counter([(None, "a clean text"), (None, None), (5, "clean")])


def test_given_columns_may_have_the_names_of_own_ones(spark, odd):
    from pyspark.sql import functions as F
    names = ["_row", "_doc", "_rank", "_times", "_pass", "_gone", "_again", "given"]
    named = odd.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    bench = spark.createDataFrame([(1, "word3 of the text word4 of the text word5 of the text word6")], "item_id long, text string")
    for step in (mixing.mixed_rows, jaccard.deduplicated, lambda d: decontaminate.clean(d, bench)):
        got = step(named)
        assert got.columns == named.columns
        rows = got.collect()
        assert rows and {tuple(r) for r in rows} <= {tuple(r) for r in named.collect()}


def test_mix_leaves_texts_where_they_are(spark):
    rows = [(None if i % 7 == 0 else i // 2, f"word {i % 5} " * (1 + i % 4), [None, "a", "b", "b", "b"][i % 5]) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        sent = mixing.mixed_rows(docs)
        got = collections.Counter()
        for r in sent.collect():
            got[r.doc_id, len(r.text.split())] += len(r.text.split())
        assert "hashpartitioning" not in sent._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    takes = collections.Counter()
    for r in mixing.mix(docs).collect():
        takes[r.doc_id, r.size] += r.taken
    assert got == +takes
