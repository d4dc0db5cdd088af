"""Two tokenizers over the same bytes, against a version that follows the definition text by text."""
import collections
import hashlib

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from fareforge.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) per text."""
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    sign = alignment.byte_of_sign()
    seen, counts = [], collections.Counter()
    for text in rows:
        spaced = " " + (text or "")
        a = a_side.encode(spaced, add_special_tokens=False).ids
        b = b_side.encode(text or "")
        a_raw = [bytes(sign[c] for c in a_side.id_to_token(i)) for i in a]
        b_raw = [bytes([int(p[3:5], 16)]) if (p := b_side.id_to_piece(i)).startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
                 for i in b]
        if not text or b"".join(a_raw) != spaced.encode() or b"".join(b_raw) != spaced.encode():
            seen.append(None)
            continue
        spans = []
        for raw in (a_raw, b_raw):
            end, out = 0, []
            for x in raw:
                out.append((end, end + len(x)))
                end += len(x)
            spans.append(out)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        links = [(i, j) for (s, e), i in zip(spans[0], a) for (t, f), j in zip(spans[1], b) if s < f and t < e]
        groups, last = [], 0
        for end in ends:
            groups.append(",".join(str(i) for (s, e), i in zip(spans[0], a) if last < e <= end) + "|" +
                          ",".join(str(i) for (s, e), i in zip(spans[1], b) if last < e <= end))
            last = end
        counts.update(links)
        seen.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if s is None else (*s[:3], len(s[3]), sum(counts[x] == best[x[1]] for x in s[3]), sum(counts[x] for x in s[3]), s[4])
            for s in seen]


ODD = [None, "", " ", "\n", "  two  blanks ", " lead", "tail ", "a▁b", "<|endoftext|> text", "x <|endoftext|>", "é ñ ü ﬁ ｆ", "\U0001f600 \U0001f468‍\U0001f469",
       "12345 67 8.9e10", "don't we'll 's", "tab\there\r\n  indented\n\n\nend", "<0x41> <s> <unk>", "\x00 nul", "中文 日本語テキスト", "w" * 3000,
       "the same words the same words " * 300, "aaaa aaa aa a", "\x1c \x85 sep x", "é combining", "one"]


def fields(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def test_odd_texts(spark):
    d = spark.createDataFrame([(i, t, "x", 1, b"y") for i, t in enumerate(ODD)], "doc_id long, text string, code string, block long, places binary")
    got = {r.doc_id: fields(r) for r in alignment.align(d.repartition(3), A, B).collect()}
    assert [got[i] for i in range(len(ODD))] == plain(ODD)


def test_small_blocks_and_whole_texts_give_the_same(spark, monkeypatch):
    texts = [t for t in ODD if t] * 3
    d = spark.createDataFrame([(None if i % 7 == 0 else i % 11, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    want = sorted((str(r.doc_id), *fields(r)) for r in alignment.align(d, A, B).collect())
    assert sorted(x[1:] for x in want) == sorted(plain(texts))
    monkeypatch.setattr(alignment, "BLOCK", 5)
    assert sorted((str(r.doc_id), *fields(r)) for r in alignment.align(d, A, B).collect()) == want
    monkeypatch.setattr(alignment, "PROBE", "▁")  # looks changed, so nothing is cut
    monkeypatch.setattr(alignment, "per_worker", lambda key, make: make())
    assert sorted((str(r.doc_id), *fields(r)) for r in alignment.align(d, A, B).collect()) == want


def test_empty(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 6000]
    d = spark.createDataFrame(short, "doc_id long, text string").repartition(5)
    got = {r.doc_id: fields(r) for r in alignment.align(d, A, B).collect()}
    assert [got[r.doc_id] for r in short] == plain([r.text for r in short])
