import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from larkspan.llm import warc as m

ROWS = [(3, "u", "aa"), (1, None, "aa"), (2, "x\ny", None), (5, "z", ""), (None, "q", "aa"), (7, "é", "ü😀"), (8, "u", "long " * 200_000), (9, "w", "b")]


@pytest.mark.parametrize("least", [0, 2, 10_000_000])
def test_round_trip(docs, monkeypatch, least):
    got = {r.id: r for r in m.read_packages(m.write_packages(docs(ROWS, "page_id long, url string, html string"), min_bytes=least)).collect()}
    assert len(got) == len(ROWS)
    first = {}
    for i, _, t in sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(t or "", i)
    for i, _, t in ROWS:
        r, data = got[i], (t or "").encode()
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = i is not None and len(data) >= least and first[t or ""] != i
        assert (r.record_type, r.refers_to) == (("revisit", first[t or ""]) if revisit else ("response", None))
        assert (r.payload is None) if revisit else bytes(r.payload) == data


def test_many_packages_and_spans(docs, monkeypatch):
    rows = [(i, f"http://h/{i}", f"page {i} " * 20) for i in range(300)]
    packages = m.write_packages(docs(rows, "page_id long, url string, html string"))
    assert packages.agg({"records": "sum"}).first()[0] == 300
    assert sorted((r.id, bytes(r.payload).decode()) for r in m.read_packages(packages).collect()) == [(i, t) for i, _, t in rows]
    assert m.read_packages(m.write_packages(docs([], "page_id long, url string, html string"))).count() == 0


def reader(data):
    reads = []

    def read(offset, size):
        reads.append(size)
        return data[offset : offset + size]

    return read, reads


def test_zip64_and_plain_directories():
    for force in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.comment = b"a comment"
            with z.open(m.ARCHIVE, "w", force_zip64=force) as f:
                f.write(b"x" * 200_000)
            z.writestr(m.INDEX, "0\t5\n")
            z.writestr(zipfile.ZipInfo("packed"), b"y" * 100, zipfile.ZIP_DEFLATED)
        read, reads = reader(out.getvalue())
        p = m.Package(read, len(out.getvalue()))
        at, size = p.locate(m.ARCHIVE)
        assert out.getvalue()[at : at + size] == b"x" * 200_000 and p.locate(m.INDEX)[1] == 4
        with pytest.raises(ValueError, match="not stored"):
            p.locate("packed")
        assert sum(reads) < 100_000  # the archive member itself was not read
    with pytest.raises(ValueError):
        m.Package(*[reader(b"no zip")[0], 6])


def test_zip64_end_record(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in ("a", "b", "c"):
            z.writestr(n, n * 10)
    data = out.getvalue()
    assert b"PK\x06\x06" in data
    p = m.Package(reader(data)[0], len(data))
    at, size = p.locate("b")
    assert data[at : at + size] == b"b" * 10 and len(p.members) == 3


def test_broken_payload():
    packed = m.record(1, "u", b"abc", None)
    assert m.parse_record(packed)["payload"] == b"abc"
    raw = zlib.decompress(packed, 31).replace(b"abc", b"abd")
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    with pytest.raises(ValueError, match="digest"):
        m.parse_record(c.compress(raw) + c.flush())




def test_empty_urls_are_named_after_the_page(docs):
    rows = [(1, "", "a"), (2, None, "b"), (3, "http://x/\n", "c")]
    got = {r.id: r.url for r in m.read_packages(m.write_packages(docs(rows, "page_id long, url string, html string"))).collect()}
    assert got == {1: "urn:page:1", 2: "urn:page:2", 3: "http://x/%0A"}
