"""Files, zips and tars from rows, written by executors to storage that they share."""

from __future__ import annotations

import io
import tarfile
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _storage(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Aside:
    """A file that is written aside and renamed at the end: readers never see a part of it, tasks hold no more than a buffer."""

    def __init__(self, folder: str, name: str):
        self.storage, base = _storage(folder)
        self.target, self.aside, self.path = f"{base}/{name}", f"{base}/{name}.{uuid.uuid4().hex}", f"{folder}/{name}"
        self.storage.create_dir(self.target.rpartition("/")[0], recursive=True)
        self.out = self.storage.open_output_stream(self.aside)

    def done(self) -> str:
        self.out.close()
        self.storage.move(self.aside, self.target)
        return self.path


def _put(folder: str, name: str, data: bytes) -> str:
    file = _Aside(folder, name)
    file.out.write(data)
    return file.done()


def export_artifacts(kv: DataFrame, folder: str) -> DataFrame:
    """Write blobs to <folder>/<id>/<type>; returns (id, type, path) when evaluated."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "type": b["type"], "path": [_put(folder, f"{i}/{t}", bytes(c)) for i, t, c in zip(b["id"], b["type"], b["content"], strict=True)]})

    return kv.select("id", "type", "content").mapInPandas(run, "id string, type string, path string")


def _grouped(members: DataFrame, keys: list[str]) -> DataFrame:
    return members.repartition(*keys).sortWithinPartitions(*keys, "member")


def _stream(members: DataFrame, keys: list[str], folder: str, suffix: str, opened, add) -> DataFrame:
    """One archive per key, members added as they stream by; returns (archive, members)."""

    def run(batches):
        key = archive = file = None
        n = 0

        def close():
            archive.close()
            return pd.DataFrame({"archive": [file.done()], "members": [n]})

        for b in batches:
            for r in b.itertuples(index=False):
                own = tuple(getattr(r, k) for k in keys)
                if own != key:
                    if archive is not None:
                        yield close()
                    key, n, file = own, 0, _Aside(folder, "/".join(map(str, own)) + suffix)
                    archive = opened(file.out)
                add(archive, r.member, bytes(r.data))
                n += 1
        if archive is not None:
            yield close()

    return _grouped(members, keys).select(*keys, "member", "data").mapInPandas(run, "archive string, members long")


def write_zips(members: DataFrame, keys: list[str], folder: str) -> DataFrame:
    return _stream(members, keys, folder, ".zip", lambda f: zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED), lambda z, name, data: z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), data))


def write_tars(members: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """<folder>/<key>/...<key>.tar of (keys, member, data) rows; empty members are left out."""

    def add(tar: tarfile.TarFile, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))

    return _stream(members.where(F.octet_length("data") > 0), keys, folder, ".tar", lambda f: tarfile.open(fileobj=f, mode="w|"), add)


def read_tars(tars: DataFrame, extensions: tuple[str, ...] = (".wav", ".flac")) -> DataFrame:
    """(path, member, data) of the members of tars given as (path, content) rows."""

    def run(batches):
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    found = [(path, m.name, tar.extractfile(m).read()) for m in tar if m.isfile() and m.name.lower().endswith(extensions)]
                yield pd.DataFrame(found, columns=["path", "member", "data"])

    return tars.select("path", "content").mapInPandas(run, "path string, member string, data binary")
