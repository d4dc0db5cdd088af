"""N-gram Jaccard join by prefix filters under several global orders.

Two shingle sets of similarity 0.75 or more share a shingle among the first quarter of either set, whatever order all
shingles are put in. The first order puts rare shingles first; documents that share one of its prefix shingles are
candidates. Candidates that share no prefix shingle under two further orders are dropped: each node keeps its prefix
shingles of those orders, and the filters of all orders are intersected. What is left is verified on whole sets. Equal
sets are one node throughout.

Every node also has a bitmap in which each of its shingles turns one bit; the bits in which two bitmaps differ are never
more than the shingles in which the sets differ, so most unlinked pairs are seen without their sets. Shingles that many
nodes share give stars instead of all pairs; nodes then propose the partners whose bitmaps differ least, and pairs that
stay open are listed at last, across the components that are already known.
"""
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import last_layer, materialize, only_result_stays, release
from .components import components
from .shingles import shingle_sets
from .token_store import mixed

#: Similarity as a fraction of whole numbers: links have LEAST[1] * shared >= LEAST[0] * union.
LEAST = (75, 100)
#: Cells of the table of shingle counts that the first order sorts by; one number per cell goes to the driver and back.
CELL_BITS = 18
#: Salts of the further orders. A node's bitmap has a power of two of bits, at least this many and BITS per shingle.
SALTS, LEAST_BITS, BITS = (21, 22), 256, 2
#: Up to so many nodes with a common prefix shingle are paired at once; rows of more frequent ones are dealt over tasks.
SMALL, HOT = 24, 4096
#: Rounds of so many proposals per row before the remaining open pairs are listed in full.
ROUNDS, PROPOSALS = 1, 4
#: Rows of a block of a run, about; a task meets two blocks at a time and sends pairs on in parts of about that many.
BLOCK, PART = 1024, 1 << 20


def prefix_length(n: int) -> int:
    return n - -(-LEAST[0] * n // LEAST[1]) + 1


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit fingerprint of a set and its size."""
    with np.errstate(over="ignore"):
        return int(mixed(np.array([mixed(tokens, 31).sum() + np.uint64(len(tokens))], np.uint64), 32).view(np.int64)[0])


def orders(tokens: np.ndarray) -> bytes:
    """Per further order the prefix shingles, as sorted 32-bit numbers."""
    p, out = prefix_length(len(tokens)), []
    for salt in SALTS:
        h = mixed(tokens, salt)
        h = np.partition(h, p - 1)[:p] if p < len(h) else h
        out.append(np.sort((h >> np.uint64(8)).astype(np.uint32)).tobytes())
    return b"".join(out)


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits turned once per shingle. A bitmap of half the size is the one half of this turned by the other."""
    size = max(LEAST_BITS, 1 << (BITS * len(tokens) - 1).bit_length())
    turned = np.bincount((mixed(tokens, 33) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(turned.astype(bool), bitorder="little").tobytes()


def folded(packed: bytes, words: int) -> np.ndarray:
    x = np.frombuffer(packed, np.uint64)
    return np.bitwise_xor.reduce(x.reshape(-1, words), axis=0)


def close(differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets that differ in at least so many shingles, of sizes with this sum, may still be similar enough."""
    a, b = LEAST
    return (a + b) * differing <= (b - a) * sizes


@contextmanager
def arrow_rows(spark, rows: int):
    """Arrow batches of so many rows for the narrow tables that are computed inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, bits) per row of docs, and (cell, n) rows that count shingles per cell with a null node."""
    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            sets = shingle_sets(b["text"].fillna("").tolist())
            for s in sets:
                cells += np.bincount((s >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells)) if len(s) > 4096 else 0
            small = [s for s in sets if 0 < len(s) <= 4096]
            if small:
                cells += np.bincount((np.concatenate(small) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "n": [len(s) for s in sets],
                                "node": pd.array([node_of(s) if len(s) else None for s in sets], "Int64"),
                                "bits": [bitmap(s) if len(s) else None for s in sets], "cell": -1})
        used = np.flatnonzero(cells)
        yield pd.DataFrame({"doc_id": pd.array([None] * len(used), "Int64"), "n": cells[used],
                            "node": pd.array([None] * len(used), "Int64"), "bits": None, "cell": used})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n long, node long, bits binary, cell int")


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, salt, node, n, pos): prefix shingles in the order of (count of the cell, shingle)."""
    counts = counts.astype(np.uint32)
    hot = HOT + 4 * int(counts.mean())

    def run(batches):
        seen = set()
        for b in batches:
            parts = []
            for s in shingle_sets(b.loc[b["doc_id"].notna(), "text"].fillna("").tolist()):
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                seen.add(node)
                often = counts[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                first = np.lexsort((s, often))[:prefix_length(len(s))]
                ways = often[first] // hot + 1
                salt = np.where(ways > 1, 1 + (node & 0x7FFFFFFF) % ways, 0)
                parts.append((s[first].view(np.int64), salt, np.full(len(first), node), np.full(len(first), len(s)), np.arange(len(first))))
            if parts:
                yield pd.DataFrame({c: np.concatenate(p) for c, p in zip(("token", "salt", "node", "n", "pos"), zip(*parts))})

    return docs.select("doc_id", "text").mapInPandas(run, "token long, salt int, node long, n int, pos int")


def may_link(n1, pos1, n2, pos2) -> np.ndarray:
    """Size filter, and whether enough shingles are left from this one on."""
    a, b = LEAST
    enough = (a + b) * np.minimum(n1 - pos1, n2 - pos2) >= a * (n1 + n2)
    return enough & (b * np.minimum(n1, n2) >= a * np.maximum(n1, n2))


PAIRS = "u long, v long, shared long, token long, n int, pos int"


def _pairs_frame(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """Distinct unordered pairs with how often they occur."""
    lo, hi = np.minimum(u, v), np.maximum(u, v)
    found = pd.DataFrame({"u": lo, "v": hi}).groupby(["u", "v"], sort=False).size().reset_index(name="shared")
    return found.assign(token=0, n=0, pos=-1)


def from_runs(rows: DataFrame) -> DataFrame:
    """Candidate pairs (pos -1) from rows sorted by shingle, and the rows of frequent shingles themselves (pos >= 0).

    Rows stream past: a run of up to SMALL rows is paired, of a longer one each row is paired with the star centre, a row
    of about its size; no run is held beyond one batch.
    """
    def run(batches):
        held, center = None, None
        for b in batches:
            x = b if held is None else pd.concat([held, b], ignore_index=True)
            t, salt = x["token"].to_numpy(), x["salt"].to_numpy()
            if not len(t):
                continue
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (salt[1:] != salt[:-1])])
            start = np.flatnonzero(new)
            last = start[-1]
            if len(t) - last <= SMALL and not (last == 0 and center == (t[0], salt[0])):
                held, x = x.iloc[last:], x.iloc[:last]
                start = start[:-1]
            else:
                held = None
            if len(x):
                out, center = _pair_runs(x, start, center)
                yield from out
        if held is not None and len(held):
            out, _ = _pair_runs(held, np.array([0]), center)
            yield from out

    def _pair_runs(x, start, center):
        t, salt, node, n, pos = (x[c].to_numpy() for c in ("token", "salt", "node", "n", "pos"))
        sizes = np.diff(np.concatenate([start, [len(t)]]))
        big_run = (sizes > SMALL) | (salt[start] > 0)
        if center is not None and center == (t[0], salt[0]):
            big_run[0] = True
        run_of = np.repeat(np.arange(len(start)), sizes)
        big, us, vs = big_run[run_of], [], []
        for d in range(1, SMALL):
            i = np.flatnonzero((run_of[d:] == run_of[:-d]) & ~big[:-d])
            if not len(i):
                break
            j = i + d
            ok = may_link(n[i], pos[i], n[j], pos[j]) & (node[i] != node[j])
            us.append(node[i][ok])
            vs.append(node[j][ok])
        for r in np.flatnonzero(big_run):
            lo, hi = start[r], start[r] + sizes[r]
            while lo < hi:
                far = lo + np.searchsorted(n[lo:hi], LEAST[1] * n[lo] // LEAST[0], "right")
                i = np.arange(lo + 1, far)
                ok = may_link(n[i], pos[i], n[lo], pos[lo]) & (node[i] != node[lo])
                us.append(node[i][ok])
                vs.append(np.full(ok.sum(), node[lo]))
                lo = max(far, lo + 1)
        out = []
        if us and sum(map(len, us)):
            out.append(_pairs_frame(np.concatenate(us), np.concatenate(vs)))
        if big.any():
            out.append(pd.DataFrame({"u": node[big], "v": 0, "shared": 0, "token": t[big], "n": n[big], "pos": pos[big]}))
        tail = (t[-1], salt[-1]) if big_run[-1] else None
        return out, tail

    return rows.mapInPandas(run, PAIRS)


def dealt(rows: DataFrame, turn: int | None, block: int = BLOCK) -> DataFrame:
    """Rows (token, band, node, component, ..) with a, b and part: the two blocks of a run that meet and the row's own.

    A run of (token, band) is cut into blocks of about `block` rows. Without a turn every two blocks meet once, those of
    the run's largest component only with the others. In a numbered turn each block stays by itself, and the blocks change
    with the turn. Runs of one component are left out.
    """
    sizes = rows.groupBy("token", "band", "component").agg(F.count(F.lit(1)).alias("n"))
    runs = sizes.groupBy("token", "band").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    runs = runs.where("kinds > 1").select("token", "band", F.col("top.component").alias("_top"), F.col("top.n").alias("_most"), "all")
    blocks = lambda n: F.ceil(n / F.lit(block))
    met = rows.join(runs, ["token", "band"])
    if turn is not None:
        alone = F.pmod(F.xxhash64("node", F.lit(turn)), blocks(F.col("all")))
        out = met.withColumns({"a": alone, "b": alone, "part": alone})
    else:
        others, largest = blocks(F.col("all") - F.col("_most")), blocks(F.col("_most"))
        top = F.col("component") == F.col("_top")
        h = F.xxhash64("node", F.lit(-1))
        part = F.when(top, others + F.pmod(h, largest)).otherwise(F.pmod(h, others))
        last = F.when(top, others).otherwise(others + largest) - 1
        out = met.withColumn("part", part).withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        out = out.withColumns({"a": F.least("part", "_with"), "b": F.greatest("part", "_with")})
    return out.select(*rows.columns, "a", "b", "part")


def across(rows: DataFrame, turn: int | None) -> DataFrame:
    """(u, v, shared): pairs of different components among rows (token, band, own, node, n, pos, component, bits, a, b, part),
    by two blocks of a run at a time; pairs whose bitmaps differ too much are left out.

    In a numbered turn each row proposes a few partners per run, those whose bitmaps differ least; without a number it
    proposes all of them.
    """
    keys = ["token", "band", "a", "b"]

    def run(batches):
        held = None
        for b in batches:
            x = b if held is None else pd.concat([held, b], ignore_index=True)
            if not len(x):
                continue
            k = x[keys].to_numpy()
            start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]).any(axis=1)]))
            held, done = x.iloc[start[-1]:], x.iloc[:start[-1]]
            if len(done):
                yield from pairs(done, start)
        if held is not None and len(held):
            yield from pairs(held, np.array([0, len(held)]))

    def pairs(x, start):
        own, node, n, pos, comp, part, bits = (x[c].to_numpy() for c in ("own", "node", "n", "pos", "component", "part", "bits"))
        n = n.astype(np.int64)
        one = (x["a"] == x["b"]).to_numpy()
        us, vs, held = [], [], 0
        for lo, hi in zip(start[:-1], start[1:]):
            c = comp[lo:hi]
            words = min(len(x) for x in bits[lo:hi]) // 8
            map_ = np.stack([folded(x, words) for x in bits[lo:hi]])
            names, count = np.unique(c, return_counts=True)
            for i in lo + np.flatnonzero(c != names[count.argmax()]):
                j = lo + np.flatnonzero((c != comp[i]) & (own[i] | own[lo:hi]) & (one[i] | (part[lo:hi] != part[i])))
                j = j[may_link(n[i], pos[i], n[j], pos[j])]
                differing = np.bitwise_count(map_[j - lo] ^ map_[i - lo]).sum(axis=1, dtype=np.int64)
                ok = close(differing, n[i] + n[j])
                j, differing = j[ok], differing[ok]
                if turn is not None and len(j) > PROPOSALS:
                    j = j[np.argpartition(differing, PROPOSALS)[:PROPOSALS]]
                us.append(np.full(len(j), node[i]))
                vs.append(node[j])
                held += len(j)
                if held >= PART:
                    yield _pairs_frame(np.concatenate(us), np.concatenate(vs))[["u", "v", "shared"]]
                    us, vs, held = [], [], 0
        if us and sum(map(len, us)):
            yield _pairs_frame(np.concatenate(us), np.concatenate(vs))[["u", "v", "shared"]]

    return rows.mapInPandas(run, "u long, v long, shared long")


def with_sides(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Pairs (u, v) with the columns of both nodes; their names get the side's letter at the end."""
    for side in "uv":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(c + side) for c in columns]), side)
    return pairs


def sifted(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The candidates (u, v, shared) whose bitmaps are close."""
    def near(batches):
        for b in batches:
            keep = np.zeros(len(b), bool)
            for k, (m, x, n, y) in enumerate(zip(b["nu"], b["bitsu"], b["nv"], b["bitsv"])):
                words = min(len(x), len(y)) // 8
                keep[k] = close(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64), m + n)
            yield b.loc[keep, ["u", "v", "shared"]]

    total = pairs.groupBy("u", "v").agg(F.sum("shared").alias("shared"))
    return with_sides(total, nodes, "n", "bits").mapInPandas(near, "u long, v long, shared long")


def share_in_all_orders(x: bytes, y: bytes) -> bool:
    """Whether two nodes have common prefix shingles under every further order."""
    sides = (np.frombuffer(o, np.uint32).reshape(len(SALTS), -1) for o in (x, y))
    return all(len(np.intersect1d(p, q)) for p, q in zip(*sides))


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The links among pairs (u, v) of nodes: those that pass the filters of the further orders, from whole shingle sets.

    Sets and prefixes are computed again from the texts of one document per node. Prefixes are met first; sets are sent for
    the pairs that are left, and met pair by pair, so a node with very many candidates is spread over tasks.
    """
    def sets(batches):
        for b in batches:
            found = [s for s in shingle_sets(b["text"].fillna("").tolist()) if len(s)]
            yield pd.DataFrame({"node": [node_of(s) for s in found], "set": [s.tobytes() for s in found], "orders": [orders(s) for s in found]})

    def in_all_orders(batches):
        for b in batches:
            keep = [share_in_all_orders(x, y) for x, y in zip(b["ordersu"], b["ordersv"])]
            yield b.loc[np.array(keep, bool), ["u", "v"]]

    def compare(batches):
        before = None
        for b in batches:
            out = []
            for u, v, node, packed in zip(b["u"], b["v"], b["node"], b["set"]):
                if before is not None and before[:2] == (u, v) and before[2] != node:
                    x, y = np.frombuffer(before[3], np.uint64), np.frombuffer(packed, np.uint64)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if LEAST[1] * shared >= LEAST[0] * (len(x) + len(y) - shared):
                        out.append((u, v))
                    before = None
                else:
                    before = (u, v, node, packed)
            yield pd.DataFrame(out, columns=["u", "v"])

    named = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = materialize(nodes.join(named, "node").select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    texts = materialize(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInPandas(
        sets, "node long, set binary, orders binary").dropDuplicates(["node"]), "sets")
    written = last_layer()
    left = materialize(with_sides(pairs.select("u", "v"), texts, "orders").mapInPandas(in_all_orders, "u long, v long"), "candidates")
    both = left.select("u", "v", F.explode(F.array("u", "v")).alias("node"))
    met = both.join(texts.select("node", "set"), "node").repartition("u", "v").sortWithinPartitions("u", "v", "node")
    links = materialize(met.mapInPandas(compare, "u long, v long"), "links")
    release(docs.sparkSession, written)
    return links


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    Null and blank texts have no shingles and link with nothing; their component is their own id. Rows without an id take
    no part and have no component. Rows that repeat an id are one document for the components; each has its own count.
    Other columns are ignored; an empty table gives an empty result.
    """
    return only_result_stays(docs.sparkSession, lambda: _join(docs), "linked")


def _join(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    described = materialize(describe(docs), "described")
    rows = described.where("cell = -1")
    counts = np.zeros(1 << CELL_BITS, np.int64)
    with arrow_rows(spark, 20_000):  # as columns: rows of so many cells would take a hundred MB of the driver
        cells = described.where("cell >= 0").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    nodes = materialize(rows.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "nodes")
    shingled = materialize(prefixes(docs, counts), "prefixes")
    prefix_layer = last_layer()
    with arrow_rows(spark, 20_000):
        sorted_rows = shingled.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "node")
        found = materialize(from_runs(sorted_rows), "runs")
    release(spark, prefix_layer)
    candidates = materialize(sifted(found.where("pos = -1"), nodes), "pairs")

    def best(pairs: DataFrame, most: int = 1) -> DataFrame:
        """For each node its candidates with the most common prefix shingles."""
        top = Window.partitionBy("node").orderBy(F.desc("shared"), "u", "v")
        each = pairs.select("u", "v", "shared", F.explode(F.array("u", "v")).alias("node"))
        return each.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= most).select("u", "v").distinct()

    # bitmaps leave few candidates that are no links, so all of them are verified at once
    tried = candidates.select("u", "v")
    links = verified(tried, docs, nodes)
    crowd = materialize(found.where("pos >= 0").select("token", F.col("u").alias("node"), "n", "pos"), "crowd")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(LEAST[1] / LEAST[0]))).cast("int")

    def late(known: DataFrame, turn: int | None) -> DataFrame:
        """Candidates of different components from runs that hold several, not tried before."""
        now = materialize(crowd.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")), "crowd")
        several = materialize(now.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
                              .where("a <> b").select("token"), "several")
        rows = now.join(several, "token", "left_semi").withColumn("band", band)
        spread = rows.withColumn("own", F.lit(True)).unionByName(rows.withColumns({"band": F.col("band") + 1, "own": F.lit(False)}))
        with arrow_rows(spark, 20_000):
            met = dealt(spread, turn).join(nodes.select("node", "bits"), "node").repartition("token", "band", "a", "b").sortWithinPartitions("token", "band", "a", "b", "n", "node")
            pairs = materialize(across(met, turn), "late")
        return sifted(pairs, nodes).join(tried, ["u", "v"], "left_anti")

    # nodes of frequent shingles propose a few partners a round, so open pairs fall as components grow; then all that is left
    turns, grown = [*range(ROUNDS), None], True
    while turns:
        turn = turns.pop(0)
        if grown:
            known = materialize(components(links), "components")
        open_pairs = late(known, turn)
        proposed = materialize(open_pairs.select("u", "v") if turn is None else best(open_pairs, PROPOSALS), "tried")
        if proposed.isEmpty():
            turns, grown = turns[-1:], False
            continue
        new = verified(proposed, docs, nodes)
        grown = not new.isEmpty()
        tried, links = tried.unionByName(proposed), links.unionByName(new)
    reps = nodes.select("node", "rep")
    named = links.join(reps.withColumnsRenamed({"node": "u", "rep": "ru"}), "u").join(
        reps.withColumnsRenamed({"node": "v", "rep": "rv"}), "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
    # equal sets link too, and so do different texts under one id
    equal = rows.where("doc_id is not null").join(reps, "node").where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    final = components(named.unionByName(equal))
    return rows.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of docs per group of linked documents, that of the smallest id, with all columns of docs.

    Rows without an id stay. Of rows that repeat an id the first by text stays. Only the ids that go, and the rows of
    repeated ids, are matched against the texts.
    """
    linked = join(docs)
    gone = linked.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    repeated = materialize(linked.where("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1")
                           .select("_again"), "repeated")
    gone = materialize(gone, "gone")
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    single = kept.join(repeated, kept["doc_id"] == repeated["_again"], "left_anti")
    several = kept.join(repeated, kept["doc_id"] == repeated["_again"], "left_semi")
    order = Window.partitionBy(docs["doc_id"]).orderBy(docs["text"].asc_nulls_last())
    ranked = several.select(F.struct("*").alias("given"), F.row_number().over(order).alias("_rank"))
    return single.unionAll(ranked.where("_rank = 1").select("given.*"))
