"""Packing: every id once, no gaps, whole documents where they fit."""
import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareforge.llm import packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, window=1024):
    """rows are pieces, texts (doc_id, text) with distinct ids."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in texts}
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert of_doc.keys() == ids.keys()
    for i, own in of_doc.items():
        at = 0
        for start, length in sorted((r.start, r.length) for r in own):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    padding = 0
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at
    assert padding < window and sorted(of_sequence) == list(range(len(of_sequence)))


def test_odd_rows(spark, odd):
    rows = [r for r in odd.collect() if r.doc_id not in (7, None)]
    some = odd.where("doc_id is not null and doc_id <> 7")
    check(packing.pack(some, TOKENIZER).collect(), [(r.doc_id, r.text) for r in rows])
    whole = packing.pack(odd, TOKENIZER).collect()
    assert sum(r.length for r in whole if r.doc_id == 7) == 2 * [r.doc_tokens for r in whole if r.doc_id == 7][0]
    assert any(r.doc_id is None for r in whole) and all(zlib.crc32(r.ids) == r.ids_crc32 for r in whole)
    assert packing.pack(odd.limit(0), TOKENIZER).count() == 0


def test_special_text_and_blanks(spark):
    texts = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "  x  y ", "\n \n", "it's 12 o'clock now", "x\x1c y", "e" * 5000, None]))
    check(packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), TOKENIZER).collect(), texts)


def test_one_hot_length(spark):
    texts = [(i, "the cat sat on a mat " * 117) for i in range(3000)]
    got = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(6), TOKENIZER).collect()
    check(got, texts)
    again = packing.pack(spark.createDataFrame(texts[:7], "doc_id long, text string"), TOKENIZER, window=64).collect()
    check(again, texts[:7], 64)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(packing.pack(docs, TOKENIZER, with_ids=False).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_other_tokenizers_are_encoded_whole(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Ünï  Cases AND  blanks, 123"
    got = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), path, end_id=2).collect()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [2]
    assert [(r.length, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == [(len(want), want)]


@pytest.mark.parametrize("seed", range(4))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 64, 5000), np.clip(rng.lognormal(3, 1, 900), 1, 63).astype(int), np.full(501, 40), rng.integers(30, 34, 77)][seed]
    histogram = np.bincount(lengths, minlength=64)
    rows, n = packing.plan(histogram, 64)
    assert sum(r[2] * (r[4] - r[3]) for r in rows) == lengths.sum() and n == -(-lengths.sum() // 64)
    if seed == 0:  # least squares finds nearly all, so few are cut
        fit = np.zeros(64)
        for combo, times in packing.least_squares(histogram, 64):
            assert times > 0 and sum(combo) == 64
            fit += times * np.bincount(combo, minlength=64)
        assert np.linalg.norm(fit - histogram) < 0.05 * np.linalg.norm(histogram)
        assert sum(r[4] - r[3] for r in rows if r[2] < r[0]) < 0.05 * len(lengths)


def test_least_squares_agrees_with_projected_gradient():
    histogram = np.bincount(np.random.default_rng(5).integers(1, 16, 300), minlength=16).astype(float)
    combos = [c for c in [(i, j, 16 - i - j) for i in range(1, 16) for j in range(i, 16)] if c[1] <= c[2]] + [(i, 16 - i) for i in range(1, 9)]
    m = np.array([np.bincount(c, minlength=16) for c in combos]).T.astype(float)
    x = np.zeros(m.shape[1])
    for _ in range(40_000):
        x = np.maximum(0, x - (m.T @ (m @ x - histogram)) / np.linalg.norm(m, 2) ** 2)
    fit = sum((t * np.bincount(c, minlength=16) for c, t in packing.least_squares(histogram, 16)), np.zeros(16))
    assert abs(np.linalg.norm(fit - histogram) - np.linalg.norm(m @ x - histogram)) < 0.5
