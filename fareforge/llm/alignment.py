"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of id pairs.

Texts are encoded by both tokenizers and cut wherever tokens of both end at the same byte. A group of one token each side
holds the same bytes on both; if those are the bytes the identity map has for the A id, the group is counted in a vector as
long as A's vocabulary. All other overlaps are pairs: tasks gather blocks of documents of a bounded number of entries, and
the distinct pairs of a block, with how often they occur there, are what the pair shuffle carries. Their corpus-wide counts
come back to the block, where each document adds up its own. The vectors (A's identity counts, the highest count per B id)
are bounded by the vocabularies and go to every task.
"""
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .wordwise import LONGEST_REMEMBERED, ByteEncoder, byte_of_sign, cut, per_worker

#: Entries of a block: distinct pairs and identities summed over its documents, about.
BLOCK = 1 << 20
#: Parts kept per worker and generation; each holds its groups and pairs.
REMEMBERED = 250_000
#: Fixed value: how byte pieces of the B file are written.
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
PROBE = "a  b ｆ ﬁ\tC"


class Pair:
    """Both tokenizers, the bytes of their tokens and the identity map, with what is known of parts of texts."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        self.a = ByteEncoder(a_path, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        sign = byte_of_sign()
        tokenizer = self.a.tokenizer
        a_bytes = [bytes(sign[c] for c in t) if t and all(c in sign for c in t) else (t or "").encode()
                   for t in map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.a_size = np.array([len(x) for x in a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.n_b = len(pieces)
        first = {}
        for i, x in enumerate(self.b_bytes):
            # of pieces with the same bytes the one that is no byte piece, since texts are made of those
            if x not in first or BYTE_PIECE.fullmatch(pieces[first[x]]):
                first[x] = i
        self.same = np.array([first.get(x, -1) for x in a_bytes], np.int64)
        self.a_bytes = a_bytes
        # B joins nothing across a blank if no piece has one inside, and if it leaves texts as they are
        inside = any("▁" in p.lstrip("▁") for p in pieces)
        self.apart = self.a.apart and not inside and self.b.normalize(PROBE) == "▁" + PROBE.replace(" ", "▁")
        self.known, self.older = {}, {}

    def look_up(self, words: list[str]) -> dict[str, tuple | None]:
        """For words after a blank: (counts, groups as text, pair codes); None where a side has other bytes.

        counts packs n_a, n_b, n_groups; a code is a * n_b + b of a linked pair, or -1 - a for an identity.
        """
        parts = [" " + w for w in words]
        raw = [p.encode("utf-8", "surrogatepass") for p in parts]
        a_ids = [self.a.after_blank(w) for w in words] if self.apart else self.a.whole(parts)
        b_ids = self.b.encode(words, num_threads=1)
        out: dict[str, tuple | None] = dict.fromkeys(words)
        good = self._same_bytes(raw, a_ids, b_ids)
        if not good:
            return out
        if len(good) < len(words):
            words, a_ids, b_ids = ([x[k] for k in good] for x in (words, a_ids, b_ids))
        a = np.frombuffer(b"".join(a_ids), self.a.kind).astype(np.int64)
        b = np.fromiter(chain.from_iterable(b_ids), np.int64)
        n_a = np.fromiter((len(x) // self.a.kind.itemsize for x in a_ids), np.int64, len(words))
        n_b = np.fromiter(map(len, b_ids), np.int64, len(words))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        low = np.searchsorted(b_end, a_end - self.a_size[a], "right")
        high = np.searchsorted(b_end - self.b_size[b], a_end, "left")
        many = high - low
        left = np.repeat(np.arange(len(a)), many)
        right = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        codes = a[left] * self.n_b + b[right]
        group_a, group_b = np.searchsorted(common, a_end, "left"), np.searchsorted(common, b_end, "left")
        alone = (np.bincount(group_a, minlength=len(common)) == 1) & (np.bincount(group_b, minlength=len(common)) == 1)
        identity = alone[group_a[left]] & (self.same[a[left]] == b[right])
        codes[identity] = -1 - a[left][identity]
        last = np.cumsum(n_a) - 1
        link_end, group_end = np.cumsum(many)[last], group_a[last] + 1
        counts = np.stack([n_a, n_b, np.diff(group_end, prepend=0)], 1).tobytes()
        packed, a_text, b_text = codes.tobytes(), list(map(str, a.tolist())), list(map(str, b.tolist()))
        a_cut = np.searchsorted(group_a, np.arange(len(common) + 1)).tolist()
        b_cut = np.searchsorted(group_b, np.arange(len(common) + 1)).tolist()
        written = [f"{a_text[i]}|{b_text[k]}" if j - i == 1 and m - k == 1 else ",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m])
                   for i, j, k, m in zip(a_cut, a_cut[1:], b_cut, b_cut[1:])]
        from_link = from_group = 0
        for n, (word, link, group) in enumerate(zip(words, link_end.tolist(), group_end.tolist())):
            out[word] = (counts[24 * n:24 * n + 24], ";".join(written[from_group:group]).encode(), packed[8 * from_link:8 * link])
            from_link, from_group = link, group
        return out

    def _same_bytes(self, raw: list[bytes], a_ids: list[bytes], b_ids: list[list[int]]) -> list[int]:
        """The parts whose tokens' bytes are the part's own on both sides."""
        b_bytes, a_bytes, kind = self.b_bytes, self.a_bytes, self.a.kind
        good = [k for k, (r, ids) in enumerate(zip(raw, b_ids)) if b"".join([b_bytes[i] for i in ids]) == r]
        if self.apart:  # A's model covers all bytes, and its pieces are those of the part
            return good
        return [k for k in good if a_ids[k] and b"".join([a_bytes[i] for i in np.frombuffer(a_ids[k], kind).tolist()]) == raw[k]]

    def documents(self, texts: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, groups as bytes, codes) of each text; None where it has no tokens."""
        words = [cut(t) if self.apart else [t] for t in texts]
        known = self.known
        new = {x for p, t in zip(words, texts) if t for x in p} - known.keys()
        if len(known) > REMEMBERED:
            self.older, self.known, known = known, {}, {}
            new = {x for p, t in zip(words, texts) if t for x in p}
        found = {x: self.older[x] for x in new if x in self.older}
        found |= self.look_up(list(new - found.keys()))
        known.update((x, v) for x, v in found.items() if len(x) <= LONGEST_REMEMBERED)
        out = []
        for p, t in zip(words, texts):
            each = [known[x] if x in known else found[x] for x in p] if t else [None]
            if None in each:
                out.append(None)
                continue
            counts = np.frombuffer(b"".join([e[0] for e in each]), np.int64).reshape(-1, 3).sum(axis=0).tolist()
            out.append((*counts, b";".join([e[1] for e in each]), np.frombuffer(b"".join([e[2] for e in each]), np.int64)))
        return out


GATHERED = ("block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "places binary, place_times binary, same binary, same_times binary, code long, n long, identity boolean")
NAMES = [c.split()[0] for c in GATHERED.split(", ")]


def gathered(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents of blocks (code null), the distinct pairs of blocks with their counts there, and identity vectors.

    A document holds the places of its pairs among the sorted codes of its block, and its identities, with how often.
    """
    def run(batches):
        from pyspark import TaskContext
        pair = per_worker(("pair", a_path, b_path), lambda: Pair(a_path, b_path))
        block = TaskContext.get().partitionId() << 32
        vector = np.zeros(len(pair.a_size), np.int64)
        rows, entries = [], 0

        def flush():
            codes = np.concatenate([r[6][r[6] >= 0] for r in rows]) if rows else np.zeros(0, np.int64)
            times = np.concatenate([r[7][r[6] >= 0] for r in rows]) if rows else np.zeros(0, np.int64)
            distinct, at = np.unique(codes, return_inverse=True)
            out, done = [], 0
            for i, (doc_id, n_a, n_b, n_groups, n_links, sha, own, count) in enumerate(rows):
                far, n = own >= 0, int((own >= 0).sum())
                packed = [at[done:done + n].astype("<i4"), count[far].astype("<i4"), (-1 - own[~far]).astype("<i4"), count[~far].astype("<i4")]
                out.append([block, i, doc_id, n_a, n_b, n_groups, n_links, sha, *[x.tobytes() for x in packed], None, None, None])
                done += n
            yield typed(out)
            if len(distinct):
                total = np.bincount(at, weights=times).astype(np.int64)
                yield counted(block, distinct, total, False)

        for b in batches:
            ids = [None if pd.isna(i) else int(i) for i in b["doc_id"]]
            for doc_id, one in zip(ids, pair.documents(b["text"].fillna("").tolist())):
                if one is None:
                    rows.append((doc_id, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
                else:
                    codes, times = np.unique(one[4], return_counts=True)
                    np.add.at(vector, -1 - codes[codes < 0], times[codes < 0])
                    rows.append((doc_id, *one[:3], len(one[4]), hashlib.sha256(one[3]).hexdigest(), codes, times))
                entries += len(rows[-1][6]) + 1
                if entries >= BLOCK:
                    yield from flush()
                    rows, entries, block = [], 0, block + 1
        if rows:
            yield from flush()
        used = np.flatnonzero(vector)
        if len(used):
            yield counted(None, used * pair.n_b + pair.same[used], vector[used], True)

    def typed(rows):
        out = pd.DataFrame(rows, columns=NAMES)
        return out.astype({c: t for c, t in TYPES.items()})

    def counted(block, codes, n, identity):
        out = pd.DataFrame({c: None for c in NAMES}, index=range(len(codes)))
        return out.assign(block=block, code=codes, n=n, identity=identity).astype(TYPES)

    return docs.select("doc_id", "text").mapInPandas(run, GATHERED)


TYPES = {c.split()[0]: {"long": "Int64", "int": "Int32", "boolean": "boolean"}[c.split()[1]]
         for c in GATHERED.split(", ") if c.split()[1] in ("long", "int", "boolean")}
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of docs (doc_id, text): RESULT, as seen by two tokenizers of a space and the text.

    Texts that are null or empty, and those whose tokens' bytes differ from the text on a side, have no tokens: zeros and an
    empty digest. Rows that repeat an id and rows without one each count for themselves; other columns are ignored; an empty
    table gives an empty result.
    """
    table = materialize(gathered(docs, a_path, b_path), "alignment")
    wanted = table.where("code is not null and not identity").select("block", "code", "n")
    counts = materialize(table.where("code is not null").groupBy("code").agg(
        F.sum("n").alias("n"), F.max("identity").alias("identity")), "pair-counts")
    n_b = piece_count(b_path)
    best_rows = counts.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("n").alias("n")).collect()  # at most one per B id
    identity_rows = counts.where("identity").select("code", "n").collect()  # at most one per A id
    best = np.zeros(n_b, np.int64)
    best[[r["b"] for r in best_rows]] = [r["n"] for r in best_rows]
    ids = np.array([r["code"] for r in identity_rows], np.int64)
    total = np.zeros(int((ids // n_b).max(initial=-1)) + 1, np.int64)
    is_best = np.zeros(len(total), bool)
    total[ids // n_b] = [r["n"] for r in identity_rows]
    is_best[ids // n_b] = total[ids // n_b] == best[ids % n_b]
    names = [c.split()[0] for c in RESULT.split(", ")]
    back = wanted.select(F.col("block").alias("home"), "code").join(counts.select("code", F.col("n").alias("total")), "code")

    def add_up(key, own, answers):
        codes = answers["code"].to_numpy(np.int64)
        order = np.argsort(codes)
        n = answers["total"].to_numpy(np.int64)[order]
        top = n == best[codes[order] % n_b]
        sums, bests = [], []
        for places, times, same, same_times in zip(own["places"], own["place_times"], own["same"], own["same_times"]):
            p, t, s, u = (np.frombuffer(x, "<i4").astype(np.int64) for x in (places, times, same, same_times))
            sums.append(int(n[p] @ t + total[s] @ u))
            bests.append(int(top[p] @ t + is_best[s] @ u))
        return own.assign(count_sum=sums, n_best=bests)[names]

    own = table.where("code is null").drop("code", "n", "identity", "row")
    return own.groupBy("block").cogroup(back.groupBy("home")).applyInPandas(add_up, RESULT)


def piece_count(b_path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
