"""Ids are remembered per worker within a small bound, at any number of distinct words."""
import random
import tracemalloc

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fareforge.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")


def many_words(n: int) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choices("abcdeéoü", k=12)) + rng.choice([".", "", "!?"]) for _ in range(n)]


def test_a_worker_keeps_little():
    words = many_words(300_000)
    texts = [" ".join(words[i:i + 300]) for i in range(0, len(words), 300)]
    encoder = token_store.Encoder(PATH)
    tracemalloc.start()
    try:
        for i in range(0, len(texts), 50):
            encoder.ids(texts[i:i + 50])
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 64e6


def test_what_was_forgotten_is_encoded_again(monkeypatch):
    texts = [" ".join(many_words(700)), " ".join(many_words(700)[:300]) + " “odd” don't", "12 x " * 40] * 2
    encoder = token_store.Encoder(PATH)
    for memory in (encoder.pieces, encoder.words):
        monkeypatch.setattr(memory, "most", 20)
    plain = Tokenizer.from_file(PATH)
    want = [plain.encode(t, add_special_tokens=False).ids + [token_store.END_ID] for t in texts]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.ids(texts)] == want
