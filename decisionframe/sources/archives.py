"""Archives as a data source: spark.read.format("archive").load(path), after register(spark).

A zip file and a plain tar file have a partition for each member, found from the directory (zip) or the headers (tar), without reading any
contents; a compressed tar file can only be read from its begin and is one partition. Members are streamed, line by line or in pieces,
and nothing is unpacked to a folder, so names in an archive can't lead anywhere. An archive inside an archive is opened in memory by the
task that reads it, if it is no larger than maxNested. Paths must be ones that all executors can open.

Options: path (a file, or a folder whose archives are taken), members (a pattern of names, `*` by default), as (`lines`: archive,
member, line, value; `bytes`: archive, member, piece, content), piece (bytes of a piece), maxNested (bytes), nested (`true`).
Folders, links and names that begin with a dot or `__MACOSX` are left out; a line that is no UTF-8 is read as Latin-1.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMAS = {"lines": "archive string, member string, line long, value string", "bytes": "archive string, member string, piece long, content binary"}
ZIP, TAR, PACKED = (".zip",), (".tar",), (".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")


def _is(name: str, kinds: tuple[str, ...]) -> bool:
    return name.lower().endswith(kinds)


def _wanted(name: str) -> bool:
    return not any(p.startswith((".", "__MACOSX")) for p in name.split("/") if p)


@dataclass
class Member(InputPartition):
    """A member of an archive; without a name all members of it. start and size are its place in a plain tar file."""

    archive: str
    name: str | None
    start: int = -1
    size: int = -1


class _Part(io.RawIOBase):
    """A range of a file."""

    def __init__(self, path: str, start: int, size: int) -> None:
        self.file, self.left = open(path, "rb"), size  # noqa: SIM115
        self.file.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(min(len(buffer), self.left))
        buffer[: len(data)] = data
        self.left -= len(data)
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.members = options["path"], options.get("members", "*")
        self.lines = options.get("as", "lines") == "lines"
        self.piece, self.most = int(options.get("piece", 8 << 20)), int(options.get("maxnested", 256 << 20))
        self.nested = options.get("nested", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        top = Path(self.path.removeprefix("file:"))
        files = [top] if top.is_file() else sorted(p for p in top.rglob("*") if p.is_file() and _is(p.name, ZIP + TAR + PACKED))
        if not files:
            raise FileNotFoundError(f"{self.path}: no archives")
        return [m for f in files for m in self._members(str(f))]

    def _members(self, path: str) -> Iterator[Member]:
        if _is(path, ZIP):
            with zipfile.ZipFile(path) as z:
                yield from (Member(path, x.filename) for x in z.infolist() if not x.is_dir() and self._asked(x.filename))
        elif _is(path, TAR):
            with tarfile.open(path, "r:") as t:
                yield from (Member(path, x.name, x.offset_data, x.size) for x in t if x.isreg() and self._asked(x.name))
        else:
            yield Member(path, None)

    def _asked(self, name: str) -> bool:
        return _wanted(name) and (fnmatch(name, self.members) or self.nested and _is(name, ZIP + TAR + PACKED))

    def read(self, partition: Member) -> Iterator[tuple]:
        if partition.name is None:
            with tarfile.open(partition.archive, "r|*") as t:
                for x in t:
                    if x.isreg() and self._asked(x.name):
                        yield from self._rows(partition.archive, x.name, t.extractfile(x))
        elif partition.start >= 0:
            with io.BufferedReader(_Part(partition.archive, partition.start, partition.size)) as f:
                yield from self._rows(partition.archive, partition.name, f)
        else:
            with zipfile.ZipFile(partition.archive) as z, z.open(partition.name) as f:
                yield from self._rows(partition.archive, partition.name, f)

    def _rows(self, archive: str, name: str, f) -> Iterator[tuple]:
        if self.nested and _is(name, ZIP + TAR + PACKED):
            yield from self._inside(archive, name, f)
        elif self.lines:
            with gzip.open(f) if name.lower().endswith(".gz") else io.BufferedReader(f) as rows:
                for k, line in enumerate(rows):
                    yield archive, name, k + 1, _text(line.removesuffix(b"\n").removesuffix(b"\r"))
        else:
            k = 0
            while data := f.read(self.piece):
                yield archive, name, k, data
                k += 1

    def _inside(self, archive: str, name: str, f) -> Iterator[tuple]:
        data = f.read(self.most + 1)
        if len(data) > self.most:
            raise ValueError(f"{archive}!{name} has more than maxNested={self.most} bytes")
        inner = f"{archive}!{name}"
        if _is(name, ZIP):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for x in z.infolist():
                    if not x.is_dir() and self._asked(x.filename):
                        with z.open(x) as g:
                            yield from self._rows(inner, x.filename, g)
        else:
            with tarfile.open(fileobj=io.BytesIO(data)) as t:
                for x in t:
                    if x.isreg() and self._asked(x.name):
                        yield from self._rows(inner, x.name, t.extractfile(x))


def _text(line: bytes) -> str:
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        kind = self.options.get("as", "lines")
        if kind not in SCHEMAS:
            raise ValueError(f"as={kind}: lines or bytes")
        return SCHEMAS[kind]

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)
