"""Members of archives as rows, read by tasks that each take a range of members.

Listing an archive reads headers only: a ZIP's central directory, or a plain TAR's headers with a seek over each payload.
Limits are held against the headers as they come, so what breaks one is refused before any payload is read.  The members are
then dealt to tasks by their packed bytes, and each task opens the archive at its own members.  A compressed TAR has no
places to start from: one task streams it, header before payload, and stops at the header that breaks a limit.

No payload above ``inline`` bytes is held whole: such a member is hashed as it streams by.  Where ``piece`` is set, it also gives
rows of so many bytes that end at line ends or, for bytes without any, where they are full.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEAD = 512
CHUNK = 1 << 20
MEMBERS = (
    "source string, path string, size_bytes bigint, compressed_bytes bigint, is_link boolean, head binary, sha256 string, content binary, problem string, "
    "piece bigint, piece_start bigint"
)
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
_NAMES = [f.split()[0] for f in MEMBERS.split(", ")]
#: What reading a broken container raises.
BROKEN = (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, RuntimeError, NotImplementedError, zlib.error, lzma.LZMAError)


@dataclass(frozen=True)
class Reading:
    """Limits of an archive, and how its members are dealt: payloads up to ``inline`` bytes are in their row, larger ones
    hashed only, or cut into rows of ``piece`` bytes; a task gets ``split`` packed bytes or one member."""

    max_entries: int = 100_000
    max_member: int = 2_147_483_648
    max_total: int = 68_719_476_736
    max_ratio: float = 500.0
    inline: int = 268_435_456
    split: int = 134_217_728
    piece: int = 0
    payloads: bool = True


@dataclass(frozen=True)
class Member:
    """A header: ``at`` is the place in a ZIP's directory, or where a TAR's payload begins."""

    path: str
    size: int
    packed: int | None
    at: int
    link: bool = False
    problem: str | None = None


class HeaderGuard:
    """Count, total and ratio over headers as they come; ``admit`` gives the code of the limit that a header breaks, after
    which nothing more may be read."""

    def __init__(self, limits: Reading, archive_bytes: int | None = None):
        self.limits, self.archive_bytes, self.entries, self.total = limits, archive_bytes, 0, 0

    def admit(self, size: int, packed: int | None = None) -> str | None:
        """``packed`` is the member's own packed size where the container has it, else the whole archive's counts."""
        limits = self.limits
        self.entries += 1
        if self.entries > limits.max_entries:
            return "source_entry_limit"
        if size > limits.max_member:
            return "source_member_limit"
        self.total += size
        if self.total > limits.max_total:
            return "source_total_limit"
        whole, part = (size, packed) if packed is not None else (self.total, self.archive_bytes)
        return "source_compression_ratio" if part and whole / part > limits.max_ratio else None


def zip_members(file, limits: Reading) -> Iterator[Member]:
    """Members of a ZIP's central directory, the last with its problem where a limit is broken."""
    guard = HeaderGuard(limits)
    with zipfile.ZipFile(file) as archive:
        for at, info in enumerate(archive.infolist()):
            problem = guard.admit(info.file_size, info.compress_size)
            link = info.external_attr >> 16 & 0o170000 == 0o120000
            if problem or not info.is_dir():
                yield Member(info.filename, info.file_size, info.compress_size, at, link, problem or ("encrypted_member" if info.flag_bits & 1 else None))
            if problem:
                return


def tar_members(archive: tarfile.TarFile, limits: Reading, archive_bytes: int) -> Iterator[tuple[Member, tarfile.TarInfo]]:
    """Members of a TAR as their headers come, the last with its problem where a limit is broken."""
    guard = HeaderGuard(limits, archive_bytes)
    while (info := archive.next()) is not None:
        regular = info.isreg()
        problem = guard.admit(info.size if regular else 0)
        if problem or not info.isdir():
            yield Member(info.name, info.size if regular else 0, None, info.offset_data, not regular, problem or (None if regular else "source_member_type")), info
        if problem:
            return
        archive.members = []  # headers already passed on are not kept


def container(file, name: str) -> str:
    """zip, tar, gz, bz2, xz (a compressed TAR), single (JSON, JSON lines), or an empty string."""
    if zipfile.is_zipfile(file):
        return "zip"
    file.seek(0)
    start = file.read(tarfile.BLOCKSIZE)
    for kind, magic in (("gz", b"\x1f\x8b"), ("bz2", b"BZh"), ("xz", b"\xfd7zXZ\x00")):
        if start.startswith(magic):
            return kind
    try:
        tarfile.TarInfo.frombuf(start, "utf-8", "surrogateescape")
        return "tar"
    except tarfile.HeaderError:
        return "single" if name.casefold().endswith((".json", ".jsonl")) else ""


def listed(file, size: int, name: str, reading: Reading) -> tuple[str, list[Member]]:
    """The container's kind and its members, by reading headers only; a compressed TAR is listed by the task that streams it."""
    kind = ""
    try:
        kind = container(file, name)
        file.seek(0)
        if kind == "zip":
            return kind, list(zip_members(file, reading))
        if kind == "tar":
            with tarfile.open(fileobj=file, mode="r:") as archive:
                return kind, [m for m, _ in tar_members(archive, reading, size)]
    except BROKEN as error:
        return "", [Member("", 0, None, 0, problem=f"invalid_container: {type(error).__name__}")]
    own = name.rstrip("/").rsplit("/", 1)[-1]
    if kind == "single":
        return kind, [Member(own, size, None, 0, problem="source_member_limit" if size > reading.max_member else None)]
    return kind, [] if kind else [Member(own, size, None, 0, problem="unsupported_source_container")]


def refused(members: list[Member]) -> bool:
    """Whether the last header broke a limit."""
    return bool(members) and members[-1].problem in ("source_entry_limit", "source_member_limit", "source_total_limit", "source_compression_ratio")


def ranges(members: list[Member], split: int) -> Iterator[list[Member]]:
    """Consecutive members of about ``split`` packed bytes together."""
    own, weight = [], 0
    for member in members:
        if own and weight + (member.packed if member.packed is not None else member.size) > split:
            yield own
            own, weight = [], 0
        own.append(member)
        weight += member.packed if member.packed is not None else member.size
    if own:
        yield own


def _rows(source: str, member: Member, stream, reading: Reading) -> Iterator[tuple]:
    """The rows of one member: its own, then its pieces where it is above ``inline`` and pieces are asked for."""

    def row(size, head=b"", digest=None, content=None, problem=None, piece=None, start=None):
        return source, member.path, size, member.packed, member.link, head, digest, content, problem, piece, start

    if member.problem or stream is None:
        yield row(member.size, digest=None if member.problem else hashlib.sha256(b"").hexdigest() if member.size == 0 else None, problem=member.problem)
        return
    digest, head, kept, size, held, n, start = hashlib.sha256(), b"", [], 0, b"", 0, 0
    small, cut = member.size <= reading.inline, bool(reading.piece)
    while data := stream.read(CHUNK):
        size += len(data)
        if size > member.size:  # more than its header says
            yield row(size, problem="source_member_limit")
            return
        digest.update(data)
        head = (head + data)[:HEAD] if len(head) < HEAD else head
        if small:
            kept.append(data)
        elif cut:
            held, at = held + data, 0
            while len(held) - at >= reading.piece:
                end = held.rfind(b"\n", at, at + reading.piece) + 1 or at + reading.piece
                yield row(member.size, content=held[at:end], piece=n, start=start)
                n, start, at = n + 1, start + end - at, end
            held = held[at:]
    if held:
        yield row(member.size, content=held, piece=n, start=start)
    if size < member.size:
        yield row(size, problem="invalid_container: EOFError")
        return
    yield row(size, head, digest.hexdigest(), b"".join(kept) if small else None)


class _Part:
    """``size`` bytes of a file from where it stands."""

    def __init__(self, file, size: int):
        self.file, self.left = file, size

    def read(self, n: int) -> bytes:
        data = self.file.read(min(n, self.left))
        self.left -= len(data)
        return data


def members_of(file, kind: str, source: str, members: list[Member], size: int, reading: Reading) -> Iterator[tuple]:
    """Rows of ``members``, in order, from an open archive of ``size`` bytes."""
    if kind == "zip":
        with zipfile.ZipFile(file) as archive:
            infos = archive.infolist()
            for member in members:
                if member.problem:
                    yield from _rows(source, member, None, reading)
                    continue
                with archive.open(infos[member.at]) as stream:
                    yield from _rows(source, member, stream, reading)
    elif kind in ("tar", "single"):
        for member in members:
            file.seek(member.at)
            yield from _rows(source, member, None if member.problem else _Part(file, member.size), reading)
    elif kind:
        unpacked = {"gz": lambda f: gzip.GzipFile(fileobj=f), "bz2": bz2.BZ2File, "xz": lzma.LZMAFile}[kind](file)
        with unpacked, tarfile.open(fileobj=unpacked, mode="r|") as archive:
            for member, info in tar_members(archive, reading, size):
                yield from _rows(source, member, archive.extractfile(info) if not member.problem and reading.payloads else None, reading)
    else:
        for member in members:
            yield from _rows(source, member, None, reading)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and the path in it."""
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def files_under(uri: str) -> list[fs.FileInfo]:
    """Files under a file or folder; names that begin with _ or . are none."""
    store, path = opened(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    if info.type == fs.FileType.File:
        return [info]
    found = store.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted((i for i in found if i.type == fs.FileType.File and i.base_name[:1] not in ("_", ".")), key=lambda i: i.path)


def uri_of(info: fs.FileInfo, given: str) -> str:
    """The file's path with the scheme of the path it was found under."""
    if "://" not in given:
        return info.path if ":" not in given.split("/")[0] else f"{given.split(':', 1)[0]}:{info.path}"
    return f"{given.split('://', 1)[0]}://{info.path}"


class _Raw(io.RawIOBase):
    """A stored file as Python's own readers expect one: places before its start are an OSError."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, to: int, whence: int = 0) -> int:
        place = to + (self.file.tell() if whence == 1 else self.file.size() if whence == 2 else 0)
        if place < 0:
            raise OSError("place before the start")
        self.file.seek(place)
        return place

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


def stored(store: fs.FileSystem, path: str) -> io.BufferedReader:
    """The file, open for reading at any place."""
    return io.BufferedReader(_Raw(store, path), 1 << 16)


class MemberRange(InputPartition):
    """Members of one archive that one task reads."""

    def __init__(self, uri: str, size: int, kind: str, members: list[Member]):
        self.uri, self.size, self.kind, self.members = uri, size, kind, members


class ArchiveReader(DataSourceReader):
    def __init__(self, uri: str, reading: Reading):
        self.uri, self.reading = uri, reading

    def partitions(self) -> list[MemberRange]:
        store, _ = opened(self.uri)

        def plan(found: fs.FileInfo) -> list[MemberRange]:
            uri, size = uri_of(found, self.uri), found.size
            with stored(store, found.path) as file:
                kind, members = listed(file, size, uri, self.reading)
            if refused(members):
                return [MemberRange(uri, size, "", members[-1:])]  # no payload of such an archive is read
            return [MemberRange(uri, size, kind, part) for part in ranges(members, self.reading.split)] or [MemberRange(uri, size, kind, [])]

        with ThreadPoolExecutor(16) as pool:
            return [part for parts in pool.map(plan, files_under(self.uri)) for part in parts]

    def read(self, partition: MemberRange) -> Iterator[pa.RecordBatch]:
        store, path = opened(partition.uri)
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)
        if not self.reading.payloads and partition.kind in ("zip", "tar", "single"):
            yield from (batch([row]) for m in partition.members for row in _rows(partition.uri, m, None, self.reading))
            return
        done = 0
        try:
            with stored(store, path) as file:
                for row in members_of(file, partition.kind, partition.uri, partition.members, partition.size, self.reading):
                    yield batch([row])
                    done += row[-2] is None  # a member's own row ends it
        except BROKEN as error:
            name = partition.members[done].path if done < len(partition.members) else ""
            yield batch([(partition.uri, name, 0, None, False, b"", None, None, f"invalid_container: {type(error).__name__}", None, None)])


class ArchiveSource(DataSource):
    """``spark.read.format("archive_members")``; options are the fields of ``Reading``."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        given = {k.casefold(): v for k, v in self.options.items()}
        kinds = {"max_ratio": float, "payloads": lambda v: v.casefold() == "true"}
        return ArchiveReader(given["path"], Reading(**{k: kinds.get(k, int)(given[k]) for k in asdict(Reading()) if k in given}))


def read_archives(spark: SparkSession, path: str, reading: Reading = Reading()) -> DataFrame:
    """One row per member of every archive under ``path`` (and one per piece, ``piece`` not null, where asked for).

    ``path`` is a file or folder of any store that Arrow opens.  An archive that breaks a limit is one row with its problem; a broken or unknown
    container likewise.  ``content`` is null above ``inline`` bytes, ``sha256`` is of the whole payload either way."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(ArchiveSource.name()).options(**{k: str(v) for k, v in asdict(reading).items()}).load(path)
