"""Archives read by ranges of members, header-first limits, pieces, trees and snapshots."""

from __future__ import annotations

import hashlib
import io
import json
import os
import random
import tarfile
import zipfile

import pytest
from ledgerloom.operators.members import RuleViolation, require_none
from ledgerloom.sources.archives import ArchiveReader, HeaderGuard, Reading, listed, ranges, read_archives
from ledgerloom.sources.exports import read_exports
from ledgerloom.sources.tree import changed, read_listing, read_tree, snapshot


class Counted(io.BytesIO):
    """Counts the bytes that are read."""

    taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


def header(name, size):
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf()


def test_oversized_first_member_is_refused_from_its_header():
    file = Counted(header("huge.bin", 4096))  # the payload is not even there
    kind, members = listed(file, 512, "hostile.tar", Reading(max_member=1024))
    assert kind == "tar" and [(m.path, m.problem) for m in members] == [("huge.bin", "source_member_limit")]
    assert file.taken <= 4 * 512


def test_entry_limit_stops_at_the_header_that_breaks_it():
    file = Counted(b"".join(header(f"item-{i}.txt", 0) for i in range(1000)) + b"\0" * 1024)
    _, members = listed(file, 513_024, "entries.tar", Reading(max_entries=2))
    assert [m.problem for m in members] == [None, None, "source_entry_limit"]
    assert file.taken <= (1 << 16) + 10 * 512  # the end is searched for a ZIP's directory, then three headers are read


def test_total_and_ratio_are_kept_as_headers_come():
    guard = HeaderGuard(Reading(max_total=10), None)
    assert [guard.admit(4), guard.admit(6), guard.admit(1)] == [None, None, "source_total_limit"]
    guard = HeaderGuard(Reading(max_ratio=2), 100)
    assert [guard.admit(150), guard.admit(60)] == [None, "source_compression_ratio"]
    guard = HeaderGuard(Reading(max_ratio=2))
    assert [guard.admit(10, 5), guard.admit(11, 5), guard.admit(0, 0)] == [None, "source_compression_ratio", None]
    payload = b"x" * 3_000_000
    file = Counted(header("a", len(payload)) + payload + b"\0" * (-len(payload) % 512) + header("b", 9) + b"\0" * 512)
    _, members = listed(file, 3_001_500, "t.tar", Reading(max_total=3_000_005))
    assert [m.problem for m in members] == [None, "source_total_limit"] and file.taken <= (1 << 16) + 20 * 512  # the first payload was passed by


def test_compressed_tar_stops_before_the_payload_that_breaks_a_limit(spark, tmp_path):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as archive:
        for name, size in (("a", 100), ("bomb", 5_000_000), ("after", 1)):
            info = tarfile.TarInfo(name)
            info.size = size
            archive.addfile(info, io.BytesIO(b"0" * size))
    import gzip

    (tmp_path / "e.tar.gz").write_bytes(gzip.compress(raw.getvalue()))
    rows = read_archives(spark, str(tmp_path / "e.tar.gz"), Reading(max_member=1000, max_ratio=1e9)).collect()
    assert [(r.path, r.problem, r.content) for r in rows] == [("a", None, bytearray(b"0" * 100)), ("bomb", "source_member_limit", None)]
    rows = read_archives(spark, str(tmp_path / "e.tar.gz"), Reading(max_ratio=50)).collect()
    assert [(r.path, r.problem) for r in rows] == [("a", None), ("bomb", "source_compression_ratio")]


def filled(rnd, size):
    return bytes(rnd.choice(b"ab\n\xc3") for _ in range(size))


@pytest.mark.parametrize("kind", ["zip", "tar", "tar.gz", "tar.xz", "tar.bz2"])
def test_members_equal_the_library_s_over_many_tasks(spark, tmp_path, kind):
    rnd = random.Random(4)
    files = {f"d/{i}.txt": filled(rnd, rnd.choice([0, 1, 700, 5000])) for i in range(40)}
    path = tmp_path / f"e.{kind}"
    if kind == "zip":
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.mkdir("d")
            for name, body in files.items():
                archive.writestr(name, body)
    else:
        with tarfile.open(path, f"w:{kind[4:]}") as archive:
            for name, body in files.items():
                info = tarfile.TarInfo(name)
                info.size = len(body)
                archive.addfile(info, io.BytesIO(body))
    reading = Reading(inline=1000, split=3000, piece=256)
    parts = ArchiveReader(str(path), reading).partitions()
    assert len(parts) > 5 if kind in ("zip", "tar") else len(parts) == 1
    rows = read_archives(spark, str(tmp_path), reading).collect()
    whole = {r.path: r for r in rows if r.piece is None}
    assert {p: (r.size_bytes, r.sha256, bytes(r.head), r.content is None) for p, r in whole.items()} == {
        p: (len(b), hashlib.sha256(b).hexdigest(), b[:512], len(b) > 1000) for p, b in files.items()
    }
    for name, body in files.items():
        pieces = sorted((r.piece, r.piece_start, bytes(r.content)) for r in rows if r.path == name and r.piece is not None)
        assert b"".join(p[2] for p in pieces) == (body if len(body) > 1000 else b"")
        assert [p[1] for p in pieces] == [sum(len(q[2]) for q in pieces[:i]) for i in range(len(pieces))] and [p[0] for p in pieces] == list(range(len(pieces)))
        assert all(len(p[2]) <= 256 and (p[2].endswith(b"\n") or len(p[2]) == 256) for p in pieces[:-1])
    assert read_archives(spark, str(path), Reading(payloads=False)).where("content is not null or (sha256 is not null and size_bytes > 0)").count() == 0


def test_broken_containers_are_one_row_with_their_problem(spark, tmp_path):
    good = io.BytesIO()
    with zipfile.ZipFile(good, "w") as archive:
        archive.writestr("a.txt", "hello" * 50)
        archive.writestr("b.txt", "fine")
    torn = bytearray(good.getvalue())
    torn[45] ^= 1  # a byte of the payload: its checksum is wrong now
    (tmp_path / "torn.zip").write_bytes(torn)
    (tmp_path / "cut.tar").write_bytes(header("x.bin", 5000) + b"12")
    (tmp_path / "what.bin").write_bytes(b"?")
    (tmp_path / "one.json").write_bytes(b"[]")
    (tmp_path / "_skipped").write_bytes(b"?")
    got = {os.path.basename(r.source): (r.path, r.problem) for r in read_archives(spark, str(tmp_path)).collect()}
    assert got == {
        "torn.zip": ("a.txt", "invalid_container: BadZipFile"), "cut.tar": ("", "invalid_container: ReadError"),
        "what.bin": ("what.bin", "unsupported_source_container"), "one.json": ("one.json", None),
    }
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_archives(spark, str(tmp_path / "none.zip")).count()


def test_exports_beyond_arrow_s_stores_are_read_whole(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    from ledgerloom.sources import exports

    with zipfile.ZipFile(tmp_path / "e.zip", "w") as archive:
        archive.writestr("a.txt", "hello")
        archive.writestr("b.json", "[]")
    (tmp_path / "bad.zip").write_bytes(b"PK\x05\x06")
    direct = sorted((r.path, r.sha256, r.problem) for r in read_exports(spark, str(tmp_path)).collect())

    def refuse(path):
        raise pa.ArrowInvalid("no such store")

    monkeypatch.setattr(exports, "opened", refuse)
    assert sorted((r.path, r.sha256, r.problem) for r in read_exports(spark, str(tmp_path)).collect()) == direct
    assert [p for p, *_ in direct if p in ("a.txt", "b.json")] == ["a.txt", "b.json"]


def test_written_tables_are_cleared_on_a_call(spark):
    from ledgerloom.sources.checkpoints import clear, shared_folder, written

    clear(spark)
    kept = written(spark.range(5).toDF("i"), "mine")
    folder = shared_folder(spark).removeprefix("file:")
    assert kept.count() == 5 and any(n.startswith("mine-") for n in os.listdir(folder))
    assert clear(spark) == 1 and not any(n.startswith("mine-") for n in os.listdir(folder)) and clear(spark) == 0


def test_ranges_hold_members_together_up_to_the_split():
    members = [type("M", (), {"packed": n, "size": n})() for n in (5, 5, 1, 100, 1, 1)]
    assert [[m.size for m in r] for r in ranges(members, 10)] == [[5, 5], [1], [100], [1, 1]]


def test_tree_links_and_snapshots(spark, tmp_path):
    root = tmp_path / "t.(ree)"
    (root / "d").mkdir(parents=True)
    (root / "a.json").write_text("{}")
    (root / "d" / "b c.txt").write_text("x")
    assert {r.path: (r.size_bytes, r.sha256) for r in read_tree(spark, str(root)).collect()} == {
        "a.json": (2, hashlib.sha256(b"{}").hexdigest()), "d/b c.txt": (1, hashlib.sha256(b"x").hexdigest()),
    }
    before = snapshot(spark, str(root))
    assert changed(before, read_listing(spark, str(root))).count() == 0
    (root / "a.json").write_text("[]")
    (root / "new").write_text("n")
    (root / "d" / "b c.txt").unlink()
    assert sorted(r.subject for r in changed(before, read_listing(spark, str(root))).collect()) == ["a.json", "d/b c.txt", "new"]
    with pytest.raises(RuleViolation):
        require_none(changed(before, read_listing(spark, str(root))))
    os.symlink(root / "a.json", root / "link")
    with pytest.raises(Exception, match="symlink_member"):
        read_tree(spark, str(root)).collect()
    assert json.loads("[]") == []
