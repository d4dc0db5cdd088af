"""Ids of whole texts from the ids of parts that a tokenizer never joins, so that each distinct part is encoded once.

A part begins at a single blank between two other characters. Whether a tokenizer keeps such parts apart is read from its
own description when it is loaded; where it may not, whole texts are encoded.
"""
import json
import os
import re
import sys
from array import array

import numpy as np
import regex

#: Parts kept with their ids per worker, in each of two generations; what neither holds is encoded again.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64
#: Fixed value: the pattern of byte-level tokenizers.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PROBE = " It's 12\u00b2 o'clock,  Ünï\u0301 \u4e2d\u6587\t\n x\u00a0y \u2581z!! ...'ll _a_ \U0001f600\u200d"
SAFE = re.compile(r"(?<=\S) (?=\S)")


def uneven(part: str) -> bool:
    """Whether a blank beside this part stood beside another white space, so that a plain split was no safe cut."""
    return not part or part[0].isspace() or part[-1].isspace()


def cut(text: str) -> list[str]:
    """Parts of a text; every part but the first has lost the blank before it."""
    parts = text.split(" ")
    return SAFE.split(text) if any(map(uneven, parts)) else parts


def kept_apart(description: dict) -> bool:
    """Whether a tokenizer splits before a single blank and joins nothing across: byte-level with its own pattern."""
    before = description.get("pre_tokenizer") or {}
    return (description.get("normalizer") is None and description.get("truncation") is None and description.get("padding") is None
            and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
            and description["model"]["type"] == "BPE" and description["model"].get("dropout") is None)


def per_worker(key, make):
    """A value that is made once per worker process and serves all its tasks."""
    kept = sys.modules["json"].__dict__.setdefault("_kept_by_fareforge", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 signs as themselves and other bytes as signs from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Recent(dict):
    """Values by key, made when they are first asked for. When it is full it becomes the older generation, whose entries
    come back when they are asked for again; values of very long keys are not kept."""

    def __init__(self, make, most: int | None = None):
        super().__init__()
        self.make, self.most, self.older = make, most or REMEMBERED, {}

    def __missing__(self, key: str):
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            self[key] = value
        return value


class ByteEncoder:
    """Ids of whole texts by a tokenizers file; `plain` takes the strings of special tokens inside texts as text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        described = json.loads(self.tokenizer.to_str())
        self.special = [] if plain else [t["content"] for t in described["added_tokens"]]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.sign = {b: ord(c) for c, b in byte_of_sign().items()}
        self.pieces = Recent(self._piece)
        self.words = Recent(self._word)
        covers = all(c in self.tokenizer.get_vocab() for c in map(chr, self.sign.values()))
        self.apart = kept_apart(described) and covers and self.part(PROBE) == self.whole([PROBE])[0]

    @classmethod
    def shared(cls, path: str, plain: bool = False) -> "ByteEncoder":
        return per_worker(("bytes", path, plain), lambda: cls(path, plain))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _piece(self, piece: str) -> bytes:
        signs = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.sign)
        return array(self.kind.char, [t.id for t in self.model.tokenize(signs)]).tobytes()

    def _word(self, word: str) -> bytes | None:
        """Ids of a word after a blank; None if a plain split was not safe here."""
        if word.isalpha():  # one piece
            return self._piece(" " + word)
        if uneven(word):
            return None
        if word[-1] in ".,;:!?" and word[:-1].isalpha():  # two
            return self.words[word[:-1]] + self.pieces[word[-1]]
        return self.part(" " + word)

    def after_blank(self, word: str) -> bytes:
        """Ids of a word after a blank, without keeping them."""
        return self._piece(" " + word) if word.isalpha() else self.part(" " + word)

    def part(self, text: str) -> bytes:
        """The same without special tokens, from the ids that the tokenizer's model has for each piece."""
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text)))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        if not self.apart:
            return self.whole(texts)
        out = []
        for t in texts:
            if self.special and any(s in t for s in self.special):
                out += self.whole([t])
            elif t:
                first, *rest = t.split(" ")
                try:
                    out.append(self.part(first) + b"".join(map(self.words.__getitem__, rest if not uneven(first) else [""])))
                except TypeError:  # blanks side by side: the safe cuts only
                    first, *rest = SAFE.split(t)
                    out.append(self.part(first) + b"".join([self.part(" " + x) if uneven(x) else self.words[x] for x in rest]))
            else:
                out.append(b"")
        return out
