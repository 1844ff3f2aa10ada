r"""WARC archives in ZIP packages, written and range-read without extraction.

A package holds two stored members: archive/data.warc.gz, whose records are gzip members of their own, and
indexes/index.tsv with each record's offset and length. The reader takes the end of the package, follows the end-of-central-
directory record and, where there is one, its ZIP64 locator, walks the central directory with its ZIP64 fields, finds
the stored members' data behind their local headers, reads the index, and then only the byte ranges of records. Ranges
of one package spread over many tasks. Every access is a positioned read on a filesystem that driver and executors
share; a retried task writes packages of its own, and only those of successful tasks are read.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a response, the others
revisit it and carry no payload; smaller ones are all responses.

Defined cases: a null payload counts as empty; a null or empty URL is written as urn:page:<id>, and line ends in URLs are percent-
encoded; a null id can be written and read but is never revisited; rows that repeat the smallest id are all responses; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import lean, new_path, written

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.tsv"
#: A package is closed once its records have so many bytes; its index then has a bounded size too.
PACKAGE_BYTES = 64 << 20
#: Bytes of records that are read at a time.
SPAN_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
#: Ids of revisits are broadcast up to so many (about 64 MB in Spark's hash table); beyond, the join shuffles.
BROADCAST_IDS = 2_000_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A gzipped record: a response, or, if it refers to another page, a revisit of that one."""
    url = (url or f"urn:page:{page}").replace("\r", "%0D").replace("\n", "%0A")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    more = f"WARC-Refers-To: <urn:page:{refers_to}>\r\nWARC-Profile: {_PROFILE}\r\n" if refers_to is not None else ""
    if refers_to is None:
        block += payload
    head = f"WARC/1.1\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: {url}\r\nWARC-Payload-Digest: sha1:{digest(payload)}\r\n{more}Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    packed = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packed.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packed.flush()


def parse_record(packed: bytes) -> dict:
    """Fields of one gzipped record; a response's digest is taken from its payload and compared with the header's."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    number = lambda s: None if s == "<urn:page:None>" else int(s[10:-1])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (digest(payload) != named or len(payload) != size):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    revisit = fields["WARC-Type"] == "revisit"
    return {"id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": named, "record_type": fields["WARC-Type"], "refers_to": number(fields["WARC-Refers-To"]) if revisit else None}


class Package:
    """Stored members of a ZIP package, by positioned reads. ``read(offset, size)`` returns bytes; ``size``: of all."""

    def __init__(self, read, size: int):
        self.read = read
        tail_at = max(0, size - (1 << 16) - 22)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        locator = tail_at + end - 20
        if locator >= 0 and (found := read(locator, 20))[:4] == b"PK\x06\x07":
            record64 = read(struct.unpack("<Q", found[8:16])[0], 56)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", record64[32:56])
        self.members = {name: m for name, *m in self._entries(read(start, length), count)}

    @staticmethod
    def _entries(directory: bytes, count: int):
        at = 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
            packed, size, n, e, c = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
            (offset,) = struct.unpack("<I", directory[at + 42 : at + 46])
            name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            extra, wide = directory[at + 46 + n : at + 46 + n + e], b""
            while len(extra) >= 4:
                kind, length = struct.unpack("<HH", extra[:4])
                if kind == 1:
                    wide = extra[4 : 4 + length]
                extra = extra[4 + length :]
            values = []
            for v in (size, packed, offset):  # in this order, and only those that don't fit
                if v == 0xFFFFFFFF:
                    v, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
                values.append(v)
            yield name, method, values[2], values[1]
            at += 46 + n + e + c

    def locate(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many there are."""
        method, offset, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        head = self.read(offset, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        return offset + 30 + sum(struct.unpack("<HH", head[26:30])), size


def open_package(path: str):
    fs, own = filesystem(path)
    f = fs.open_input_file(own)
    return f, Package(lambda offset, size: f.read_at(size, offset), f.size())


def _with_refers(pages: DataFrame, min_bytes: int) -> DataFrame:
    keys = pages.select("id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")).where((F.col("n") >= min_bytes) & F.col("id").isNotNull())
    first = keys.groupBy("sha", "n").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    revisits = written(keys.join(first, ["sha", "n"]).where(F.col("id") != F.col("refers_to")).select("id", "refers_to", "sha"), "revisits").dropDuplicates(["id", "sha"])
    few = revisits.count() <= BROADCAST_IDS
    return pages.withColumn("sha", F.sha1("payload")).join(F.broadcast(revisits) if few else revisits, ["id", "sha"], "left").drop("sha")


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record per row; returns the written table (package, records) of the packages."""
    lean(pages.sparkSession)
    folder = folder or new_path(pages.sparkSession, "warc")

    def run(batches):
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        turn, out, package, index, at, mine = 0, None, None, [], 0, f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"

        def close():
            member.close()
            package.writestr(INDEX, "".join(f"{a}\t{n}\n" for a, n in index))
            package.close()
            out.close()
            return pd.DataFrame({"package": [f"{folder}/{mine}-{turn}.zip"], "records": [len(index)]})

        for batch in batches:
            for r in batch.itertuples(index=False):
                if package is None:
                    out = fs.open_output_stream(f"{base}/{mine}-{turn}.zip")
                    package = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    member, index, at = package.open(ARCHIVE, "w", force_zip64=True), [], 0
                packed = record(None if pd.isna(r.id) else int(r.id), r.url, r.payload, None if pd.isna(r.refers_to) else int(r.refers_to))
                member.write(packed)
                index.append((at, len(packed)))
                at += len(packed)
                if at >= PACKAGE_BYTES:
                    yield close()
                    turn, package = turn + 1, None
        if package is not None:
            yield close()

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    return written(_with_refers(rows, min_bytes).select("id", "url", "payload", "refers_to").mapInPandas(run, "package string, records long"), "packages")


_RECORD = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``packages`` (package): id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""

    def spans(batches):
        for batch in batches:
            for path in batch["package"]:
                f, package = open_package(path)
                with f:
                    start, _ = package.locate(ARCHIVE)
                    at, size = package.locate(INDEX)
                    entries = [tuple(map(int, line.split("\t"))) for line in f.read_at(size, at).decode().splitlines()]
                own: list[tuple[int, int]] = []
                for entry in [*entries, None]:
                    if own and (entry is None or entry[0] + entry[1] - own[0][0] > SPAN_BYTES):
                        yield pd.DataFrame({"package": [path], "offset": [start + own[0][0]], "sizes": [[n for _, n in own]]})
                        own = []
                    if entry is not None:
                        own.append(entry)

    def read(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                fs, own = filesystem(r.package)
                with fs.open_input_file(own) as f:
                    data = f.read_at(int(sum(r.sizes)), r.offset)
                at, found = 0, []
                for n in r.sizes:
                    found.append(parse_record(data[at : at + n]))
                    at += n
                table = pd.DataFrame(found)
                yield table.astype({"id": "Int64", "refers_to": "Int64"}) if with_payload else table.drop(columns="payload").astype({"id": "Int64", "refers_to": "Int64"})

    found = written(packages.select("package").mapInPandas(spans, "package string, offset long, sizes array<long>"), "warc-spans")
    return found.repartition(max(1, -(-found.count() // 4))).mapInPandas(read, _RECORD + ", payload binary" * with_payload)
