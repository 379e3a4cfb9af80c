"""The commit of an output with faults at each step, retained files, and sources that change under an import."""

from __future__ import annotations

import hashlib
import json
import os
import random
import zipfile

import pytest
from ledgerloom.operators.members import RuleViolation
from ledgerloom.operators.messages import canonical_conversations, canonical_messages
from ledgerloom.plans import outputs
from ledgerloom.plans.imports import import_members, write_import
from ledgerloom.plans.outputs import Store, commit, recover, retain
from ledgerloom.sources.archives import Reading
from ledgerloom.plans.registry import Adapter, adapter, adapter_names, descriptors, register
from ledgerloom.sources.exports import read_export_pieces, read_exports
from ledgerloom.sources.tree import changed, read_listing, read_tree, snapshot
from pyspark.sql import functions as F


def tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(folder) for f in names}


def made(folder, text):
    folder.mkdir()
    (folder / "a").write_text(text)
    return str(folder)


class Failing(Store):
    """Fails at the n-th rename or delete, before or after doing it."""

    def __init__(self, spark, path, at, after):
        super().__init__(spark, path)
        self.at, self.after = at, after

    def step(self, do):
        self.at -= 1
        if self.at == 0 and not self.after:
            raise OSError("injected")
        do()
        if self.at == 0:
            raise OSError("injected")

    def rename(self, old, new):
        self.step(lambda: Store.rename(self, old, new))

    def delete(self, path):
        self.step(lambda: Store.delete(self, path))


@pytest.mark.parametrize("at", [1, 2, 3])
@pytest.mark.parametrize("after", [False, True])
def test_a_fault_at_any_step_leaves_one_tree_whole(spark, tmp_path, at, after):
    old, new = made(tmp_path / "out", "old"), made(tmp_path / "out.staging-1", "new")
    with pytest.raises(OSError, match="injected"):
        commit(Failing(spark, old, at, after), new, old, replace=True)
    recover(spark, old)
    assert tree(old) in ({"a": b"old"}, {"a": b"new"})
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_driver_that_dies_between_the_moves_is_recovered(spark, tmp_path):
    made(tmp_path / "out.previous-1", "old"), made(tmp_path / "out.staging-1", "new")
    recover(spark, str(tmp_path / "out"))
    assert tree(tmp_path / "out") == {"a": b"old"} and len(list(tmp_path.iterdir())) == 1
    made(tmp_path / "out.previous-2", "older")
    recover(spark, str(tmp_path / "out"))
    assert tree(tmp_path / "out") == {"a": b"old"} and len(list(tmp_path.iterdir())) == 1


def test_commit_without_an_earlier_output_and_without_leave(spark, tmp_path):
    staging = made(tmp_path / "s", "new")
    store = Store(spark, staging)
    commit(store, staging, str(tmp_path / "out"), replace=False)
    assert tree(tmp_path / "out") == {"a": b"new"}
    with pytest.raises(FileExistsError):
        commit(store, made(tmp_path / "t", "newer"), str(tmp_path / "out"), replace=False)
    assert tree(tmp_path / "out") == {"a": b"new"} and tree(tmp_path / "t") == {"a": b"newer"}


def export(path, files):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("conversations.json", json.dumps([{"id": "c", "mapping": {}}]))
        for name, body in files.items():
            archive.writestr(name, body)
    return str(path)


def test_retained_files_are_the_members_bytes_whether_held_or_streamed(spark, tmp_path):
    rnd = random.Random(3)
    files = {"notes.md": b"mail a@b.io", "deep/er/x y.json": b"{}", "big.txt": bytes(rnd.choice(b"ab \n") for _ in range(90_000))}
    members = read_exports(spark, export(tmp_path / "e.zip", files), reading=Reading(inline=1000))
    assert members.where("content is null").count() == 1
    rows = retain(members.where("path <> 'conversations.json'"), str(tmp_path / "kept")).collect()
    assert {k: v for k, v in tree(tmp_path / "kept").items() if not k.endswith(".crc")} == files
    assert {r.path: (r.stored_path, r.size_bytes, r.sha256) for r in rows} == {k: (k, len(v), hashlib.sha256(v).hexdigest()) for k, v in files.items()}
    with pytest.raises(Exception, match="unsafe_path"):
        retain(members.selectExpr("source", "'../up' as path", "size_bytes", "sha256", "content"), str(tmp_path / "kept")).collect()
    with pytest.raises(Exception, match="source_changed"):
        retain(members.selectExpr("source", "path", "size_bytes", "'00' as sha256", "content"), str(tmp_path / "kept")).collect()


def test_texts_too_large_for_a_row_are_searched_in_pieces(spark, tmp_path):
    rnd = random.Random(5)
    said = "".join(rnd.choice(["word ", "a@b.io ", "x\n", "ghp_" + "x1" * 15 + " "]) for _ in range(9000))
    source = export(tmp_path / "e.zip", {"big.md": said.encode(), "small.md": b"c@d.io"})
    small = Reading(inline=1000, piece=20_000)
    members = read_exports(spark, source, reading=small)
    with pytest.raises(RuleViolation, match="unscanned_member"):
        import_members(members, "openai")
    pieces = read_export_pieces(spark, source, small)
    assert pieces.count() > 2
    told = lambda result: sorted((r.path, r.rule_id, r.sha256, r.occurrences) for r in result.findings.collect())
    assert told(import_members(members, "openai", pieces=pieces)) == told(import_members(read_exports(spark, source), "openai"))
    with pytest.raises(RuleViolation, match="unscanned_member"):
        import_members(members, "openai", pieces=pieces.where("path = 'none'"))


def notes(name="notes"):
    """A vendor of its own: every .note member is a conversation, each of its lines a message."""

    def parsed(payloads):
        rows = payloads.select("source_path", F.posexplode(F.split("raw", "\n")).alias("source_index", "text"))
        stamp = {"adapter_id": F.lit("notes/1"), "source_vendor": F.lit("own"), "source_type": F.lit("own.notes")}
        heads = payloads.select("source_path", F.lit(0).alias("source_index"), F.col("source_path").alias("source_conversation_id"), F.lit("a note").alias("title"))
        said = rows.withColumns({"conversation_id": F.col("source_path"), "source_message_id": F.concat_ws(":", "source_path", F.col("source_index").cast("string")), "role": F.lit("user"), "attachment_refs": F.regexp_extract_all("text", F.lit("see (\\S+)"), F.lit(1))})
        return canonical_conversations(heads.withColumns(stamp)), canonical_messages(said.withColumns(stamp))

    decide = lambda path: F.when(path.endswith(".secret"), F.struct(F.lit("reject").alias("decision"), F.lit("own_rule").alias("reason")))
    return Adapter(name, "notes/1", "own", "own.notes", discover=lambda m: m.where("path like '%.note'"), parse=parsed, override=decide)


def test_an_adapter_of_one_s_own_is_plugged_in_by_name(spark, tmp_path):
    register(notes(), replace=True)
    assert "notes" in adapter_names() and "grok" in adapter_names() and descriptors(spark).where("name = 'notes'").first().adapter_id == "notes/1"
    with pytest.raises(ValueError, match="adapter_exists"):
        register(notes())
    with pytest.raises(ValueError, match="unknown_adapter"):
        adapter("none")
    wave = b"RIFF\0\0\0\0WAVE" + b"\0" * 50
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as archive:
        for name, body in {"a.note": "hi\nsee song.wav", "x/song.wav": wave, "k.secret": "s", "other.md": "text"}.items():
            archive.writestr(name, body)
    result = import_members(read_exports(spark, str(tmp_path / "e.zip")), "notes")
    assert [(r.source_message_id, r.text) for r in result.messages.orderBy("source_index").collect()] == [("a.note:0", "hi"), ("a.note:1", "see song.wav")]
    assert {r.source_path: (r.disposition, r.reason) for r in result.provenance.collect()}["k.secret"] == ("reject", "own_rule")
    assert [(r.path, r.reference_match, r.reference_count) for r in result.tombstones.collect()] == [("x/song.wav", "exact", 1)]


@pytest.mark.parametrize("decision, code", [("maybe", "invalid_member_decision"), ("extract", "unsupported_extract_kind")])
def test_decisions_an_adapter_may_not_take(spark, tmp_path, decision, code):
    own = notes("odd")
    odd = Adapter("odd", "notes/1", "own", "own.notes", own.discover, own.parse, override=lambda path: F.when(path.endswith(".md"), F.struct(F.lit(decision).alias("decision"), F.lit("r").alias("reason"))))
    register(odd, replace=True)
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as archive:
        archive.writestr("a.note", "hi")
        archive.writestr("b.md", "hi")
    with pytest.raises(RuleViolation, match=code):
        import_members(read_exports(spark, str(tmp_path / "e.zip")), "odd")


def test_replaced_output_is_the_new_import_and_a_failed_one_leaves_the_old(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    export(source / "e.zip", {"notes.md": b"first"})
    write_import(import_members(read_exports(spark, str(source)), "openai"), out)
    assert tree(out)["retained/notes.md"] == b"first"
    manifest = {line.split("  ")[1]: line.split("  ")[0] for r in spark.read.text(f"{out}/manifest").collect() for line in [r.value]}
    assert manifest["retained/notes.md"] == hashlib.sha256(b"first").hexdigest()
    listed = {r.path: r.sha256 for r in read_tree(spark, out).collect() if not r.path.startswith("manifest/")}
    assert {k: v for k, v in listed.items() if not k.split("/")[-1].startswith(("_", "."))} == manifest

    export(source / "e.zip", {"notes.md": b"second"})
    before = snapshot(spark, str(source))
    result = import_members(read_exports(spark, str(source)), "openai")
    export(source / "e.zip", {"notes.md": b"third, written meanwhile"})
    with pytest.raises(RuleViolation, match="source_changed"):
        write_import(result, out, replace=True, unchanged=changed(before, read_listing(spark, str(source))))
    assert tree(out)["retained/notes.md"] == b"first" and sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]

    monkeypatch.setattr(outputs.Store, "rename", lambda self, old, new: (_ for _ in ()).throw(OSError("injected")))
    with pytest.raises(OSError, match="injected"):
        write_import(import_members(read_exports(spark, str(source)), "openai"), out, replace=True)
    monkeypatch.undo()
    assert tree(out)["retained/notes.md"] == b"first"
    write_import(import_members(read_exports(spark, str(source)), "openai"), out, replace=True)
    assert tree(out)["retained/notes.md"] == b"third, written meanwhile" and sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]
