"""WARC archives with a two-level capture index.

Captures are written as gzip members into archive files. Their index lines (reversed-host key, page, file, offset,
length) are range-sorted; every range becomes one index file of compressed blocks with a sparse directory (first key,
place of the block) at its end, and one row per index file names its range. A lookup bisects the file ranges, then the
file's directory, then the lines of one block, and only then reads the capture's byte range.
"""
import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize
from .files import RangeReader, attempt_name, open_store

#: Payloads of fewer bytes are always full responses.
LEAST_BYTES = 0
BLOCK_LINES = 256
#: An archive file is closed and a new one begun past this size.
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
LINE = "key string, page_id long, digest string, archive string, at long, size long"
INDEX = "part int, name string, first string, last string, lines long, directory long, size long"


def reversed_host_key(url: Column) -> Column:
    """com,example,www)/path?query: host labels reversed, scheme, port and fragment left out, host in lower case."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://|#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?:]*)", 1))
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(url: str, page_id, digest: str, payload: bytes, size: int, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit keeps digest and size of the payload it leaves out."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {url}", f"WARC-Date: {DATE}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers of a record, with the payload and its size."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogateescape").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return fields | {"size": size, "payload": payload}


def captures(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """pages (page_id, url, html) with key, sha1 (hex), bytes and refers_to.

    Digests are grouped before the join, so a payload that a third of the pages share sends one row per task; the join
    is left to adaptive splitting.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    each = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A").alias("url"), html.alias("payload"))
    each = each.withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    groups = each.select("page_id", "sha1", "bytes").groupBy("sha1").agg(
        F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.max("bytes").alias("_bytes"))
    shared = materialize(groups.where((F.col("_n") > 1) & (F.col("_bytes") >= least)).select("sha1", "_first"), "shared")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("_first")), F.col("_first"))
    return (each.join(shared, "sha1", "left")
            .select("page_id", "url", "payload", "sha1", "bytes", refers.alias("refers_to"),
                    reversed_host_key(F.col("url")).alias("key")))


def write_archives(found: DataFrame, folder: str) -> DataFrame:
    """Write the captures as they are partitioned; returns the committed index lines."""
    def write(batches):
        fs, root = open_store(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        for b in batches:
            lines = []
            for page, url, payload, sha1, size, refers, key in zip(
                    b["page_id"], b["url"], b["payload"], b["sha1"], b["bytes"], b["refers_to"], b["key"]):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = attempt_name("capture") + ".warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                page, refers = (None if pd.isna(v) else int(v) for v in (page, refers))
                digest = base32_sha1(sha1)
                member = gzip.compress(record(url, page, digest, payload, size, refers), 6, mtime=0)
                out.write(member)
                lines.append((key, page, digest, name, at, len(member)))
                at += len(member)
            yield pd.DataFrame(lines, columns=["key", "page_id", "digest", "archive", "at", "size"]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return materialize(found.mapInPandas(write, LINE), "lines")


def write_index(lines: DataFrame, folder: str, block: int = BLOCK_LINES) -> list:
    """Range-sort the lines into index files; returns one row per file, in order."""
    def write(batches):
        fs, root = open_store(folder)
        name, out, at, held, directory, count = attempt_name("index"), None, 0, [], [], 0

        def flush():
            nonlocal at, held
            packed = zlib.compress("\n".join(held).encode("utf-8", "surrogateescape"), 6)
            directory.append((held[0].split("\t", 1)[0], at, len(packed)))
            out.write(packed)
            at, held = at + len(packed), []

        last = ""
        for b in batches:
            for sort, digest, archive, offset, size in zip(b["sort"], b["digest"], b["archive"], b["at"], b["size"]):
                out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                held.append(f"{sort}\t{digest}\t{archive}\t{offset}\t{size}")
                last, count = sort, count + 1
                if len(held) >= block:
                    flush()
        if out is None:
            return
        if held:
            flush()
        packed = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(packed)
        out.close()
        from pyspark import TaskContext
        yield pd.DataFrame([(TaskContext.get().partitionId(), name, directory[0][0], last, count, at, len(packed))],
                           columns=[c.split()[0] for c in INDEX.split(", ")])

    ranged = lines.select(sort_column().alias("sort"), "digest", "archive", "at", "size").repartitionByRange("sort")
    return materialize(ranged.sortWithinPartitions("sort").mapInPandas(write, INDEX), "index").orderBy("part").collect()


def sort_column() -> Column:
    clean = F.regexp_replace("key", r"[\t\n]", "%09")
    number = F.lpad((F.col("page_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat_ws(" ", clean, F.coalesce(number, F.lit("")))


class CaptureIndex:
    """Binary search over index files, directories and blocks; the block last used stays unpacked."""

    def __init__(self, folder: str, files: list[tuple]):
        self.reader, self.files = RangeReader(folder), files
        self.firsts = [f[1].encode() for f in files]
        self.directory, self.block = (None, None, None), (None, None)

    def find(self, sort: str) -> list[list[str]]:
        """The lines (digest, archive, offset, size) of one sort key; equal keys lie in one index file."""
        want = sort.encode()
        i = max(bisect.bisect_right(self.firsts, want) - 1, 0)
        if self.directory[0] != i:
            name, _, at, size = self.files[i]
            rows = json.loads(zlib.decompress(self.reader.read(name, at, size)))
            self.directory = (i, [r[0].encode() for r in rows], rows)
        _, firsts, rows = self.directory
        k, found = max(bisect.bisect_left(firsts, want) - 1, 0), []
        while k < len(rows) and (firsts[k] <= want or k == 0):
            if self.block[0] != (i, k):
                text = zlib.decompress(self.reader.read(self.files[i][0], rows[k][1], rows[k][2])).decode("utf-8", "surrogateescape")
                split = [x.split("\t") for x in text.split("\n")]
                self.block = ((i, k), [x[0].encode() for x in split], split)
            keys, split = self.block[1:]
            lo, hi = bisect.bisect_left(keys, want), bisect.bisect_right(keys, want)
            found += [x[1:] for x in split[lo:hi]]
            k += 1
        return found


def look_up(wanted: DataFrame, folder: str, files: list) -> DataFrame:
    """The places (page_id, archive, at, size) of all captures of the wanted (key, page_id), each asked for once.

    Wanted keys are range-sorted like the index, so a task walks few index files and each block once.
    """
    schema = "archive string, at long, size long"
    places = [(f.name, f.first, f.directory, f.size) for f in files]

    def search(batches):
        index = CaptureIndex(folder, places)
        for b in batches:
            found = [(x[1], int(x[2]), int(x[3])) for s in b["sort"] for x in index.find(s)]
            yield pd.DataFrame(found, columns=["archive", "at", "size"])

    if not files:
        return wanted.sparkSession.createDataFrame([], schema)
    keys = wanted.select(sort_column().alias("sort")).distinct().repartitionByRange("sort").sortWithinPartitions("sort")
    return keys.mapInPandas(search, schema)


def fetch(places: DataFrame, folder: str) -> DataFrame:
    """Range-read captures: (page_id, payload_bytes, payload_digest, record_type, refers_to, url).

    Places are sorted by archive and offset first, so reads of one archive run forward.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    number = re.compile(r"<urn:page:(-?\d*)>")

    def read(batches):
        files = RangeReader(folder)
        for b in batches:
            rows = []
            for archive, at, size in zip(b["archive"], b["at"], b["size"]):
                r = parse_record(gzip.decompress(files.read(archive, at, size)))
                digest, refers = r["WARC-Payload-Digest"][5:], r.get("WARC-Refers-To")
                if refers is None and base32_sha1(hashlib.sha1(r["payload"]).hexdigest()) != digest:
                    raise ValueError(f"payload of {r['WARC-Record-ID']} is damaged")
                page = number.match(r["WARC-Record-ID"])[1]
                rows.append((int(page) if page else None, r["size"], digest, r["WARC-Type"],
                             int(number.match(refers)[1]) if refers else None, r["WARC-Target-URI"]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    return places.repartitionByRange("archive", "at").sortWithinPartitions("archive", "at").mapInPandas(read, schema)


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write a record per page, then read every page back through the index.

    Null html is an empty payload, a null url an empty one. Among equal payloads the smallest page_id is the response
    (also in each row that repeats it) and all others revisit it; rows without a page_id revisit it too and are full
    responses where no row of their payload has an id. Other columns are ignored; an empty table gives an empty result.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    lines = write_archives(captures(pages, least), folder)
    files = write_index(lines, folder)
    wanted = pages.select("page_id", reversed_host_key(F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A")).alias("key"))
    return fetch(look_up(wanted, folder, files), folder)
