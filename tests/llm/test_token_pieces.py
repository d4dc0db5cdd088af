"""New pieces of plain text are asked of the tokenizer's model; only odd words go through the whole tokenizer."""
import random

import numpy as np
import public_tokenizers
import tokenizers

from fareforge.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")


class Counted:
    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode(self, *args, **named):
        self.calls += 1
        return self.inner.encode(*args, **named)


def test_plain_pieces_skip_the_whole_tokenizer(tmp_path, monkeypatch):
    path = tmp_path / "again.json"  # a path that no encoder knows yet
    path.write_bytes(open(PATH, "rb").read())
    plain = tokenizers.Tokenizer.from_file(PATH)
    counted = Counted(tokenizers.Tokenizer.from_file(PATH))

    class Loaded:
        from_file = staticmethod(lambda _: counted)

    monkeypatch.setattr(tokenizers, "Tokenizer", Loaded)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéÀüßÿÑ", k=8)) + rng.choice(["", ",", "'s", "12", "###"]) for _ in range(1000)]
    texts = [" ".join(words[:500]), "\n".join(words[500:]), "I'LL $'s x'D 'tis a'b \x0b\x0c``{~ <|endoftext|>x <|y " + "w" * 3000,
             "“Odd” é İstanbul  x\xa0y ﬁ Straße's ½ 漢字 " + " ".join(words[:20])]
    encoder = token_store.Encoder(str(path))
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.ids(texts)]
    assert encoder.by_words and got == [plain.encode(t, add_special_tokens=False).ids + [token_store.END_ID] for t in texts]
    assert counted.calls < 30
