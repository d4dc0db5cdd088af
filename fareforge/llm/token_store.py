"""Token ids in binary shards with a minimal perfect hash per shard.

Documents are range-partitioned by id. Every task encodes its range, streams the raw ids into one shard file and
writes an index beside it: a minimal perfect hash from keys to slots, and per slot the offset, the length and a
fingerprint of the key that tells strangers apart. A key costs a few hash probes and one range read, whatever the size.
"""
import io
import json
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize
from .files import RangeReader, attempt_name, open_store
from .wordwise import Recent, byte_of_sign, per_worker

END_ID = 2
#: Pieces, and words of odd texts, kept with their ids per worker, in each of two generations; others are encoded again.
PIECES_REMEMBERED, WORDS_REMEMBERED = 120_000, 40_000
#: How the tokenizer cuts lower-case text, limited to characters that its normaliser leaves alone.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[{LATIN} \t\n\x0b\x0c\r!-~]*")
PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~]+")
WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
#: What such a tokenizer must give like the cuts above; one that does not is given whole texts.
PROBE, ODD = "It's 3 Ünïted-Straße WORDS,  don't\n(x)12% éÀ", " \u201cquoted\u201d e\u0301 \u0130 <|x "
ROOMY = 2.0
MANIFEST = "part int, name string, has_null boolean, first long, last long, docs long, ids long"


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser: distinct numbers stay distinct."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hashes(ids: np.ndarray, null: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """Keys are (id or null, how many rows of that id came before)."""
    base = mixed(ids.astype(np.int64).view(np.uint64), 101) ^ np.where(null, np.uint64(0x5DEECE66D), np.uint64(0))
    return mixed(base + mixed(repeat.astype(np.uint64), 102) * (repeat > 0), 103)


class PerfectHash:
    """Minimal perfect hash in levels of bit arrays: keys that are alone in their bit stay, the others go one level down.
    A key's slot is the number of bits set before its own."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, parts = [], []
        while len(keys):
            if len(sizes) > 60:
                raise ValueError("keys repeat")
            size = max(64, int(len(keys) * ROOMY + 63) // 64 * 64)
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where a key finds none; keys that were not built in may find any slot."""
        out = np.full(len(keys), -1, np.int64)
        start = 0
        for level, size in enumerate(self.sizes):
            todo = np.flatnonzero(out < 0)
            at = (mixed(keys[todo], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            there = ((self.bits[word] >> bit) & np.uint64(1)).astype(bool)
            low = np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[there]] = (self.before[word] + low)[there]
            start += int(size)
        return out


def pack_index(keys: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    hashed = PerfectHash.build(keys)
    slots = hashed.slots(keys)
    table = np.zeros((len(keys), 2), np.int64)
    prints = np.zeros(len(keys), np.uint32)
    table[slots] = np.stack([offsets, lengths], axis=1)
    prints[slots] = (mixed(keys, 777) >> np.uint64(32)).astype(np.uint32)
    out = io.BytesIO()
    for part in (np.array([width], np.int64), hashed.sizes, hashed.bits, table, prints):
        np.save(out, part)
    return out.getvalue()


class ShardIndex:
    def __init__(self, packed: bytes):
        file = io.BytesIO(packed)
        width, sizes, bits, self.table, self.prints = (np.load(file) for _ in range(5))
        self.width, self.hash = int(width[0]), PerfectHash(sizes, bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """(offset, length) in ids per key; length -1 where the shard has no such key."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == (mixed(keys[known], 777) >> np.uint64(32)).astype(np.uint32)
        out = np.full((len(keys), 2), -1, np.int64)
        out[known] = self.table[slots[known]]
        return out


def cuts_like_here(tokenizer) -> bool:
    """Whether a tokenizer lower-cases, drops white space, cuts before signs and digits and gives each cut to a byte-level BPE,
    by its own description, without the long one of its vocabulary."""
    steps, cuts = (json.loads(x.__getstate__()) if x else {} for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
    steps, cuts = {s["type"] for s in steps.get("normalizers", [])}, cuts.get("pretokenizers", [])
    if [c["type"] for c in cuts] != ["Split", "ByteLevel"] or tokenizer.truncation or tokenizer.padding:
        return False
    split, level = cuts
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return (all(a.startswith("<|") and WORD.fullmatch(a) for a in added) and "Lowercase" in steps and split["behavior"] == "Removed"
            and split["invert"] and split["pattern"].get("Regex", "").endswith("|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and not level["add_prefix_space"] and not level.get("use_regex", True)
            and type(tokenizer.model).__name__ == "BPE" and not tokenizer.model.dropout)


class Encoder:
    """Ids of whole texts from the ids of their pieces.

    The tokenizer drops white space and never joins across it, and it lower-cases and cuts words, digits and signs apart
    before its model looks for ids. Texts of Latin letters, digits and ASCII signs are cut the same way here, and the model
    is asked for each piece that a worker does not remember. Other texts go word by word: their words of such characters
    are cut too, words with any other character go to the tokenizer whole. A tokenizer whose description or whose ids of a
    probe say that it works otherwise is given whole texts.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.kind.itemsize
        self.sign = {b: ord(c) for c, b in byte_of_sign().items()}
        self.pieces, self.words = Recent(self._piece, PIECES_REMEMBERED), Recent(self._word, WORDS_REMEMBERED)
        self.by_words = cuts_like_here(self.tokenizer) and all(self._text(t) == self._whole(t) for t in (PROBE, PROBE + ODD))

    @classmethod
    def shared(cls, tokenizer_path: str) -> "Encoder":
        """Workers serve many tasks: what one has encoded is kept for the next."""
        return per_worker(("pieces", tokenizer_path), lambda: cls(tokenizer_path))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        signs = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.sign)
        return array(self.kind.char, [t.id for t in self.model.tokenize(signs)]).tobytes()

    def _cut(self, text: str) -> bytes | None:
        """Ids of a text that is cut here; None if it has other characters or may have special tokens."""
        if not PLAIN.fullmatch(text) or "<|" in text:
            return None
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        found = self._cut(word)
        return self._whole(word) if found is None else found

    def _text(self, text: str) -> bytes:
        found = self._cut(text)
        return b"".join(map(self.words.__getitem__, WORD.findall(text))) if found is None else found

    def ids(self, texts: list[str]) -> list[bytes]:
        end = np.array([END_ID], self.kind).tobytes()
        if not self.by_words:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(x.ids, self.kind).tobytes() + end for x in found]
        return [self._text(t) + end for t in texts]


class _Repeats:
    """Numbers the rows of one id in sorted order, across batches."""

    def __init__(self):
        self.last, self.count = None, -1

    def of(self, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        for i, key in enumerate(zip(null.tolist(), ids.tolist())):
            self.count = self.count + 1 if key == self.last else 0
            self.last, out[i] = key, self.count
        return out


def _numbers(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    null = column.isna().to_numpy()
    return column.fillna(0).to_numpy().astype(np.int64), null


def write_store(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> tuple[str, list]:
    """Encode and write all rows of docs (doc_id, text) in ascending id order, null ids first; a null text is empty.

    Returns the folder and one manifest row per shard, in order. Rows that repeat an id stand side by side.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")

    def write(batches):
        fs, root = open_store(folder)
        fs.create_dir(root, recursive=True)
        encoder, repeats, name, out = Encoder.shared(tokenizer_path), _Repeats(), attempt_name("shard"), None
        keys, lengths, edge = [], [], []
        for batch in batches:
            if not len(batch):
                continue
            out = out or fs.open_output_stream(f"{root}/{name}.bin")
            ids, null = _numbers(batch["doc_id"])
            payload = encoder.ids(batch["text"].fillna("").tolist())
            out.write(b"".join(payload))
            lengths.append(np.array([len(p) // encoder.width for p in payload], np.int64))
            keys.append(key_hashes(ids, null, repeats.of(ids, null)))
            known = ids[~null]
            edge = [edge and edge[0] or bool(null.any()), edge[1] if edge and edge[1] is not None else known[0] if len(known) else None,
                    known[-1] if len(known) else edge[2] if edge else None]
        if out is None:
            return
        out.close()
        lengths = np.concatenate(lengths)
        packed = pack_index(np.concatenate(keys), np.cumsum(lengths) - lengths, lengths, encoder.width)
        with fs.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(packed)
        from pyspark import TaskContext
        yield pd.DataFrame([[TaskContext.get().partitionId(), name, edge[0], edge[1], edge[2], len(lengths), int(lengths.sum())]],
                           columns=[c.split()[0] for c in MANIFEST.split(", ")]).astype({"first": "Int64", "last": "Int64"})

    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    shards = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInPandas(write, MANIFEST)
    return folder, materialize(shards, "shards").orderBy("part").collect()


def read_store(ids: DataFrame, folder: str, manifest: list) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for every row of ids (doc_id) that the store has.

    Shard borders, one small row per shard, go to every task; indexes and payloads are read where they are needed.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    names = [m.name for m in manifest]
    firsts = np.array([-2**63 if m.has_null else m.first for m in manifest], np.int64)
    starts = np.concatenate([[0], np.cumsum([m.ids for m in manifest])]).astype(np.int64)

    def read(batches):
        files, repeats, held = RangeReader(folder), _Repeats(), (None, None)
        for batch in batches:
            ids, null = _numbers(batch["doc_id"])
            keys = key_hashes(ids, null, repeats.of(ids, null))
            shard = np.where(null, 0, np.searchsorted(firsts, ids, "right") - 1)
            rows = []
            for s in np.unique(shard):
                here = np.flatnonzero(shard == s)
                if held[0] != s:
                    held = (s, ShardIndex(files.whole(f"{names[s]}.idx")))
                index = held[1]
                spans = index.find(keys[here])
                for i, (offset, length) in zip(here, spans.tolist()):
                    if length < 0:
                        continue
                    raw = files.read(f"{names[s]}.bin", offset * index.width, length * index.width)
                    wide = np.frombuffer(raw, f"<u{index.width}").astype("<u4").tobytes()
                    rows.append((None if null[i] else int(ids[i]), int(starts[s]) + offset, length, zlib.crc32(wide)))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    if not manifest:
        return ids.sparkSession.createDataFrame([], schema)
    by = F.col("doc_id").asc_nulls_first()
    return ids.select("doc_id").repartitionByRange(by).sortWithinPartitions(by).mapInPandas(read, schema)


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write docs and read every document back by its key.

    (doc_id, start, n_tokens, ids_crc32): null and empty texts are the end id alone; rows that repeat an id are
    documents of their own; other columns are ignored; an empty table gives an empty result.
    """
    folder, manifest = write_store(docs, tokenizer_path)
    return read_store(docs, folder, manifest)
