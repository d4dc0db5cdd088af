"""Every operator on empty tables and on odd rows with clashing extra columns."""
import base64
import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fareforge.llm import (decontaminate, extract, host_rules, jaccard, language, license, mixing, quality, token_store,
                           warc)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, 0), (8, 0, 0), (8, 1, 0), (4, 0, None), (None, 1, 0), (99, 1, 0), (1, None, 1)], LABELS)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "word3 of the text word4 of the text word5 of the text word6 of the text word7"),
                                  (2, None), (3, ""), (4, "too short"), (None, "word1 of the text " * 9)], "item_id long, text string")


OPS = {
    "mix": lambda d, *_: mixing.mix(d), "mixed_rows": lambda d, *_: mixing.mixed_rows(d),
    "rules": lambda d, *_: host_rules.judge(d), "license": lambda d, *_: license.scan(d),
    "quality": lambda d, lab, _: quality.classify(d, lab), "accepted": lambda d, lab, _: quality.accepted(d, lab),
    "leaks": lambda d, _, b: decontaminate.check(d, b), "clean": lambda d, _, b: decontaminate.clean(d, b),
    "tokens": lambda d, *_: token_store.round_trip(d, TOKENIZER), "language": lambda d, *_: language.identify(d),
    "jaccard": lambda d, *_: jaccard.join(d), "deduplicated": lambda d, *_: jaccard.deduplicated(d),
}


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, odd, labels, bench, name):
    assert OPS[name](odd.limit(0), labels.limit(0), bench.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["mix", "rules", "license", "quality", "leaks", "tokens", "language", "jaccard"])
def test_one_row_per_row(odd, labels, bench, name):
    got = OPS[name](odd, labels, bench)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r.doc_id) for r in odd.collect())


@pytest.mark.parametrize("name", ["mixed_rows", "accepted", "clean", "deduplicated"])
def test_filters_keep_columns(odd, labels, bench, name):
    got = OPS[name](odd, labels, bench)
    assert got.columns == odd.columns
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in odd.collect()}


def test_no_benchmark_and_no_labels(odd, labels, bench):
    assert decontaminate.check(odd, bench.limit(0)).where("contaminated").count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_rules_values(odd):
    got = {r.doc_id: r for r in host_rules.judge(odd).where("doc_id is not null").collect()}
    assert (got[1].n_words, got[3].n_words, got[1].base_failed, got[1].kept) == (0, 0, True, False)
    assert (got[8].n_words, got[8].n_repeat_words, got[8].base_failed) == (120_000, 120_000, True)
    assert (got[-9].n_words, got[-9].word_chars, got[-9].n_symbols) == (3, 7, 3)
    assert got[10].word_chars == 100_000


def test_license_values(spark):
    texts = ["All rights reserved, ALL RIGHTS RESERVED", "Licensed under CC BY-NC 4.0.", "cc by", "general public",
             "This work is licensed under the terms of the GNU General Public License, version 3", None, "rights"]
    got = license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got] == [
        (6, 2, 0, 3, "reserved", "reserved"), (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc"), (2, 1, 0, 0, "cc-by", "cc-by"),
        (2, 0, None, None, "", ""), (15, 1, 10, 10, "gpl", "gpl,gpl-3.0"), (0, 0, None, None, "", ""), (1, 0, None, None, "", "")]


def test_slots_tell_reparameterised_questions(spark):
    item = "Q: On Monday Anna bought 7 apples and paid 3 dollars then gave 7 apples to Ben and left the shop for good"
    same = item.replace("7", "9").replace("3", "4").replace("Anna", "Carl")
    mixed = item.replace("gave 7", "gave 5").replace("3", "9")
    d = spark.createDataFrame([(1, item), (2, same), (3, mixed), (4, item.upper())], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        found = {r.doc_id: r.items for r in decontaminate.leaks(d, b, limit).collect()}
        assert found.get(1) == "1" and found.get(2) == "1" and 3 not in found


def test_duplicates_and_ids(odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (10, 1, 10), (None, 156, None)} <= got
    assert {c for i, _, c in got if i in (5, 6, 7)} == {5}
    kept = [r.doc_id for r in jaccard.deduplicated(odd).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 2, 3, 4, 5, 8, None, -9, 10]))


def test_mix_shares(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 50 as int))").alias("text"),
                                 F.expr("case when id % 3 = 0 then 'a' when id % 40 = 1 then 'b' when id % 2 = 0 then 'c' end").alias("source"))
    got = mixing.mix(d).withColumn("source_size", F.col("source_size")).groupBy("target", "source_size").agg(
        F.sum("taken").alias("taken"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= 100 and r.over <= 0 and r.target <= 3 * r.source_size for r in got)
    assert abs(sum(r.target for r in got) - sum(i % 50 for i in range(4000))) < 1e-6


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, digest long")


def test_warc_values(spark):
    rows = [(3, "https://www.Example.com/a?b#c", "<p>x</p>"), (1, "http://example.com", "<p>x</p>"), (2, None, None), (5, "x\r\ny", ""),
            (None, "http://b.example.com/", "<p>x</p>"), (7, "http://example.com", "é" * 70_000), (None, None, "alone")]
    got = warc.round_trip(pages(spark, [r + ("k", 1) for r in rows])).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    key = lambda r: (str(r[0]), r[1])
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted([
        (3, 8, sha("<p>x</p>"), "revisit", 1), (1, 8, sha("<p>x</p>"), "response", None), (2, 0, sha(""), "response", None),
        (5, 0, sha(""), "revisit", 2), (None, 8, sha("<p>x</p>"), "revisit", 1), (7, 140_000, sha("é" * 70_000), "response", None),
        (None, 5, sha("alone"), "response", None)], key=key)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_extract_values(spark):
    body = "<nav><a href=/>Home</a></nav><article><h1>A title</h1><p>First &amp; best<br>line<p>Second one.</article><footer>&copy; me</footer>"
    rows = [(1, "u", f"<html><head><title>t</title><script>var x='<p>';</script></head><body>{body}"), (2, "u", None), (3, None, ""),
            (4, "u", "<p"), (1, "u", "no tags at all, only a line of text.")]
    got = extract.extract(pages(spark, [r + ("k", 1) for r in rows])).collect()
    assert sorted((r.page_id, r.n_chars == len(r.text)) for r in got) == [(1, True), (1, True), (2, True), (3, True), (4, True)]
    assert "A title\nFirst & best line\nSecond one." in {r.text for r in got}
    assert extract.extract(pages(spark, [])).count() == 0
