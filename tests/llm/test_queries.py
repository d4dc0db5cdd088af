"""Registered corpus queries against brute force on the given tables."""
import base64
import collections
import hashlib
import html
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from fareforge.llm import mixing, quality, token_store

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name, sf=SF):
    return entry.queries()[name](spark, sf)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(texts):
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def normal(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def leaked(spark, texts):
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return {i for i, t in texts.items() if any(x in normal(t) for x in items)}


def stored(rows):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text) in order of id."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op1(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()
    first, want = {}, set()
    for r in pages:
        raw = (r.html or "").encode()
        to = first.setdefault(raw, r.page_id)
        kind = ("response", None) if to == r.page_id else ("revisit", to)
        want.add((r.page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind))
    got = run(spark, "op1_warc").collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == len(pages)


def test_op4_accuracy(spark):
    scored = run(spark, "op4_quality", LARGER)
    held = scored.where("held_out").join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert scored.where("score < 0 or score > 1 or (predicted = 1) <> (score >= 0.3)").count() == 0


def test_op5(spark, docs):
    got = {r.doc_id for r in run(spark, "op5_decontaminate").where("contaminated").collect()}
    assert got == leaked(spark, {i: r.text for i, r in docs.items()})


def test_op7(spark, docs):
    got = run(spark, "op7_token_store").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == stored([(i, r.text) for i, r in docs.items()])


def test_tokenizer_pieces():
    e = token_store.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for t in ["It's DON'T ,'s x'S <|endoftext|> ab<|startoftext|>c É é naïve ½ 12.5 a_b—c “q” 中文 ﬁ z y \x1c# µm", "", " \n", "a" * 500]:
        assert np.frombuffer(e.ids([t])[0], e.kind).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids + [2]


def test_perfect_hash():
    keys = np.unique(token_store.mixed(np.arange(5000, dtype=np.uint64), 5))
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    index = token_store.ShardIndex(token_store.pack_index(keys, np.arange(5000), np.ones(5000, int), 2))
    assert (index.find(keys)[:, 0] == np.arange(5000)).all()
    strangers = token_store.mixed(np.arange(5000, 9000, dtype=np.uint64), 5)
    assert (index.find(strangers)[:, 1] >= 0).sum() <= 1


def test_op8_accuracy(spark):
    truth = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    held = run(spark, "op8_language", LARGER).where("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_op9(spark):
    got = {r.page_id: r.text for r in run(spark, "op9_extract").collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = r.html[r.html.index("<article>"):].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:h1|p|article)>", article)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def test_op10(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op10_jaccard").collect()}
    assert got == components({i: r.text for i, r in docs.items()})


def test_pipeline(spark, docs):
    """Each stage against brute force on its own input; the classifier and the mix against their own operators."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, table, SF)
    passed = {r.doc_id for r in quality.classify(table, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == passed and good.columns == table.columns
    texts = {i: docs[i].text for i in passed}
    single = {i for i, (_, c) in components(texts).items() if c == i}
    assert {r.doc_id for r in stages["n-gram Jaccard join"](spark, good, SF).collect()} == single
    clean = single - leaked(spark, {i: texts[i] for i in single})
    rows = table.where(table.doc_id.isin(list(clean)))
    taken = collections.Counter({r.doc_id: r.taken // r.size for r in mixing.mix(rows).collect() if r.taken})
    sent = [(i, docs[i].text) for i, k in taken.items() for _ in range(k)]
    got = entry.queries()["pipeline"](spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(stored(sent))
