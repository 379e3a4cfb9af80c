"""Sources, adapters and the import of whole exports, on small ones built here."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile

import pytest
from ledgerloom.operators.members import RuleViolation
from ledgerloom.plans.adapters import parse
from ledgerloom.plans.checks import payload_violations
from ledgerloom.plans.imports import Limits, account_metadata, import_members, write_import
from ledgerloom.sources.docx import extract_documents
from ledgerloom.sources.exports import read_exports
from ledgerloom.sources.tree import read_tree
from ledgerloom.sources.json_rows import all_strings, is_strict_json
from ledgerloom.streaming.drop_folder import collect_folder
from pyspark.sql import functions as F


def payloads(spark, **files):
    return spark.createDataFrame([(k.replace("__", "/") + ".json", json.dumps(v) if not isinstance(v, str) else v) for k, v in files.items()], "source_path string, raw string")


def zipped(path, files):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in files:
            archive.writestr(name, body)
    return str(path)


CHATGPT = [
    {
        "id": "c1", "title": "First",
        "mapping": {
            "root": {"id": "root", "message": None, "children": ["z"]},
            "z": {"parent": "root", "children": ["a"], "message": {"id": "m1", "author": {"role": "user"}, "create_time": 1.5, "content": {"parts": ["see", {"text": "demo.wav"}, 3]}}},
            "a": {"parent": "z", "children": [], "message": {"id": "m2", "author": {"role": "ASSISTANT"}, "create_time": True, "content": {"parts": ["file-ABC123def"]}}},
        },
    }
]


def test_mapping_keeps_the_order_of_the_file(spark):
    conversations, messages = parse(payloads(spark, conversations=CHATGPT), "openai")
    assert [(r.source_conversation_id, r.title) for r in conversations.collect()] == [("c1", "First")]
    got = messages.orderBy("source_index").collect()
    assert [(r.source_message_id, r.source_index, r.role, r.text, r.create_time) for r in got] == [("m1", 1, "user", "see\ndemo.wav", "1.5"), ("m2", 2, "assistant", "file-ABC123def", None)]
    assert got[0].attachment_refs == ["demo.wav"] and got[1].attachment_refs == ["file-abc123def"] and got[0].source_children_ids == ["a"]


def test_nested_vendors(spark):
    grok = {"conversations": [{"conversation": {"id": "g", "title": "T"}, "responses": [{"response": {"_id": "1", "sender": "human", "message": "hi", "partial": True, "file_attachments": ["b", "a", "b"], "agent_thinking_traces": ["x"]}}, {"response": {"_id": "2", "conversation_id": "other", "sender": "GROK", "message": {"no": 1}}}]}]}
    _, messages = parse(payloads(spark, prod__grok=grok), "grok")
    got = messages.orderBy("source_message_id").collect()
    assert [(r.conversation_id, r.role, r.text, r.status, r.attachment_refs) for r in got] == [("g", "user", "hi", "partial", ["a", "b"]), ("other", "assistant", "", None, [])]
    claude = [{"uuid": "u", "name": "N", "chat_messages": [{"uuid": "m", "sender": "human", "text": None, "content": [{"text": "one"}, "two"], "files": [{"file_name": "f.txt"}, "g"]}], "vendor_only": {"secret": 1}}, {"uuid": "without"}]
    conversations, messages = parse(payloads(spark, conversations=claude), "claude")
    assert conversations.count() == 1
    assert messages.select("role", "text", "attachment_refs").first() == ("user", "one\ntwo", ["f.txt", "g"])
    gemini = {"conversations": [{"id": 7, "entries": [{"id": "e", "role": "model", "response": "ok", "timestamp": "t"}]}]}
    conversations, messages = parse(payloads(spark, gemini=gemini), "gemini")
    assert messages.select("conversation_id", "role", "text", "create_time").first() == ("7", "assistant", "ok", "t")
    with pytest.raises(ValueError, match="unknown_adapter"):
        parse(payloads(spark, a=[]), "none")


def test_flat_lines_are_grouped_in_key_order(spark):
    lines = "\n".join(json.dumps(r) for r in [{"conversation_id": "b", "message_id": "1", "role": "user", "text": "x", "title": "B"}, {"conversation_id": "a", "message_id": "2", "role": "model", "text": "y"}, {"conversation_id": "b", "message_id": "3", "text": "z"}])
    rows = spark.createDataFrame([("chat.jsonl", lines + "\r\n\r\n")], "source_path string, raw string")
    conversations, messages = parse(rows, "generic")
    assert [(r.source_conversation_id, r.source_index, r.title) for r in conversations.orderBy("source_index").collect()] == [("a", 0, None), ("b", 1, "B")]
    assert [(r.conversation_id, r.source_index, r.role) for r in messages.orderBy("source_index").collect()] == [("b", 0, "user"), ("a", 1, "assistant"), ("b", 2, None)]


def test_issue_tracker_threads(spark):
    files = {
        "pull_requests": [{"id": 9, "number": 2, "body": "change", "user": {"login": "ann"}, "created_at": "1"}],
        "pull_request_reviews": [{"id": 50, "pull_request_id": 9, "body": "fine", "user": {"login": "bo"}, "created_at": "2"}],
        "review_comments": [{"id": 60, "pull_request_review_id": 50, "body": "here", "author": "cy", "created_at": "3"}, {"id": 61, "pull_request_review_id": 99, "body": "lost"}],
        "issue_comments": [{"id": 70, "issue_id": 9, "body": ""}],
    }
    conversations, messages = parse(payloads(spark, **files), "github")
    assert conversations.select("title").first()[0] == "GitHub pull request 2"
    assert [(r.source_message_id, r.role, r.name, r.text) for r in messages.orderBy("create_time").collect()] == [("9:body", "author", "ann", "change"), ("50", "commenter", "bo", "fine"), ("60", "commenter", "cy", "here")]


def test_issue_tracker_records_keep_their_places(spark):
    files = [
        ("b/issues.json", [{"id": 3, "body": "z", "updated_at": "9"}]), ("a/issues_1.json", [{"id": 1, "body": "x"}, {"id": 2, "body": ""}]), ("c/pull_requests.json", [{"id": 4}]),
        ("a/issue_comments.json", [{"id": 70, "issue_id": 2, "body": "gone", "created_at": "1"}, {"id": 71, "issue_id": 3, "body": "said", "created_at": "2", "updated_at": "3"}]),
    ]
    conversations, messages = parse(spark.createDataFrame([(p, json.dumps(r)) for p, r in files], "source_path string, raw string"), "github")
    assert [(r.source_path, r.source_conversation_id, r.source_index) for r in conversations.orderBy("source_index").collect()] == [
        ("a/issues_1.json", "1", 0), ("a/issues_1.json", "2", 1), ("b/issues.json", "3", 2), ("c/pull_requests.json", "4", 3),
    ]
    assert sorted((r.source_message_id, r.source_path, r.source_index, r.update_time) for r in messages.collect()) == [
        ("1:body", "a/issues_1.json", 0, None), ("3:body", "b/issues.json", 0, "9"), ("70", "a/issue_comments.json", 0, None), ("71", "a/issue_comments.json", 1, "3"),
    ]


def test_flat_gemini_rows(spark):
    rows = [{"thread_id": "b", "id": "1", "role": "model", "prompt": "x", "title": "B"}, {"conversation_id": "a", "id": "2", "text": "y"}, {"thread_id": "b", "id": "3", "response": "z"}]
    conversations, messages = parse(payloads(spark, myactivity=rows), "gemini")
    assert [(r.source_conversation_id, r.source_index, r.title) for r in conversations.orderBy("source_index").collect()] == [("a", 0, None), ("b", 1, "B")]
    assert [(r.conversation_id, r.source_index, r.text) for r in messages.orderBy("source_index").collect()] == [("b", 0, "x"), ("a", 1, "y"), ("b", 2, "z")]


def test_issue_tracker_lines_and_lists_under_keys(spark):
    thread, comment = {"id": 9, "number": 2, "body": "change", "created_at": "1"}, {"id": 70, "issue_id": 9, "body": "said", "created_at": "2"}
    files = [("issues.jsonl", json.dumps(thread) + "\n"), ("issue_comments_1.json", json.dumps({"records": [comment]})), ("issue_comments_2.json", json.dumps({"issue_comments": [comment | {"id": 71}]}))]
    conversations, messages = parse(spark.createDataFrame(files, "source_path string, raw string"), "github")
    assert conversations.select("title").first()[0] == "GitHub issue 2"
    assert sorted(r.source_message_id for r in messages.collect()) == ["70", "71", "9:body"]


def test_import_of_a_zip(spark, tmp_path):
    wave = b"RIFF\0\0\0\0WAVE" + b"\0" * 50
    files = [("conversations.json", json.dumps(CHATGPT)), ("notes.md", "mail a@b.io"), ("assets/demo.wav", wave), ("x.dat", wave), ("tool.exe", b"MZ"), ("paper.pdf", b"%PDF-"), ("user.json", '{"id":1,"email":"e","secret":"s"}')]
    members = read_exports(spark, zipped(tmp_path / "export.zip", files))
    result = import_members(members, "openai")
    stats = result.statistics().first()
    assert (stats.files_keep, stats.files_tombstone, stats.files_reject, stats.files_seen, stats.conversations, stats.messages) == (3, 2, 1, 6, 1, 2)
    described = {r.path: (r.reference_match, r.reference_count) for r in result.tombstones.collect()}
    assert described == {"assets/demo.wav": ("exact", 1), "x.dat": ("none", 0)}
    assert {r.source_path: r.disposition for r in result.provenance.collect()}["conversations.json"] == "normalized"
    assert [(r.path, r.rule_id) for r in result.findings.collect()] == [("notes.md", "email_address")]
    assert {r.path: r.reason for r in result.members.where("decision = 'keep'").collect()}["paper.pdf"] == "document_retained_no_frozen_extraction"
    assert account_metadata(members, {"user.json": ["id", "email"], "notes.md": ["id"]}).collect() == [("user.json", '{"email":"e","id":1}')]
    out = str(tmp_path / "out")
    write_import(result, out)
    lines = [r.value for r in spark.read.text(f"{out}/messages").collect()]
    assert [json.loads(x)["source_message_id"] for x in lines] == ["m2", "m1"]  # no written time sorts first
    sums = {r.value.split("  ")[1]: r.value.split("  ")[0] for r in spark.read.text(f"{out}/manifest").collect()}
    tree = {r.path: r.sha256 for r in read_tree(spark, out).collect()}
    assert sums and all(tree[p] == s for p, s in sums.items())
    with pytest.raises(FileExistsError):
        write_import(result, out)


@pytest.mark.parametrize(
    "files, limits, code",
    [
        ([("../up.txt", "x")], Limits(), "unsafe_path"),
        ([("a/./b", "x"), ("a/b", "y")], Limits(), "path_collision"),
        ([("big.txt", "0" * 200_000)], Limits(max_ratio=2.0), "source_compression_ratio"),
        ([("a", "12"), ("b", "12")], Limits(max_total=3), "source_total_limit"),
        ([("a", "12"), ("b", "12")], Limits(max_entries=1), "source_entry_limit"),
    ],
)
def test_hostile_zips_are_refused(spark, tmp_path, files, limits, code):
    with pytest.raises(RuleViolation) as caught:
        import_members(read_exports(spark, zipped(tmp_path / "e.zip", files)), "openai", limits=limits)
    assert caught.value.code == code


@pytest.mark.parametrize(
    "adapter, files, code",
    [
        ("openai", [("notes.md", "x")], "openai_conversation_discovery"),
        ("openai", [("conversations.json", "[{]")], "invalid_json"),
        ("openai-common", [("conversations.json", '[{"id":"a"},3]')], "unsupported_openai_shape"),
        ("grok", [("a/prod-grok-backend.json", "{}"), ("b/prod-grok-backend.json", "{}")], "grok_backend_cardinality"),
        ("grok", [("prod-grok-backend.json", "[]")], "invalid_grok_backend_shape"),
        ("grok", [("prod-grok-backend.json", '{"conversations":{}}')], "invalid_grok_conversations"),
        ("grok", [("prod-grok-backend.json", '{"conversations":[{"responses":[]}]}')], "invalid_grok_conversation_wrapper"),
        ("claude", [("conversations.json", '[{"uuid":"u"}]')], "unsupported_claude_shape"),
        ("claude", [("conversations.json", '{"a":1,"a":1}')], "invalid_claude_json"),
        ("gemini", [("gemini.json", '[{"text":"x"}]')], "unsupported_gemini_shape"),
        ("gemini", [("gemini.json", '{"conversations":[{"id":1}]}')], "unsupported_gemini_shape"),
        ("github", [("issue_comments.json", "[]")], "github_thread_discovery"),
        ("github", [("issues.json", '[{"title":"t"}]')], "github_missing_thread_id"),
        ("github", [("issues.jsonl", '{"id":1}\n[]')], "invalid_github_resource_shape"),
        ("generic", [("a.jsonl", '{"conversation_id":1}\n{')], "invalid_jsonl"),
        ("generic", [("a.json", '[{"messages":[1]}]')], "invalid_generic_message"),
    ],
)
def test_payloads_that_cannot_be_read_are_refused(spark, tmp_path, adapter, files, code):
    with pytest.raises(RuleViolation) as caught:
        import_members(read_exports(spark, zipped(tmp_path / "e.zip", files)), adapter)
    assert caught.value.code == code


def test_offending_lines_have_their_number(spark):
    rows = spark.createDataFrame([("a.jsonl", '{"conversation_id":1}\n\n{"conversation_id":1,"conversation_id":2}\r\n[]')], "source_path string, raw string")
    assert sorted((r.code, r.subject) for r in payload_violations(rows, "generic").collect()) == [("invalid_generic_jsonl_row", "a.jsonl:4"), ("invalid_jsonl", "a.jsonl:3")]
    flat = spark.createDataFrame([("gemini.json", '[{"thread_id":1},3]')], "source_path string, raw string")
    assert payload_violations(flat, "gemini").collect() == []


def test_tombstones_by_conversation_strings_and_by_message_attachments(spark, tmp_path):
    said = [{"id": "c1", "title": "T", "mapping": {"n": {"message": {"id": "m1", "author": {"role": "user"}, "content": {"parts": ["hi"]}, "metadata": {"attachments": [{"name": "song.wav"}]}}}}}]
    wave = b"RIFF\0\0\0\0WAVE" + b"\0" * 50
    files = [("conversations.json", json.dumps(said)), ("conversations-1.json", json.dumps([{"id": "c2", "mapping": {}}])), ("a/song.wav", wave), ("file-ABC123def.wav", wave)]
    members = read_exports(spark, zipped(tmp_path / "e.zip", files))
    for adapter in ("openai", "openai-common"):
        result = import_members(members, adapter)
        assert {r.path: (r.reference_match, r.reference_count, r.source_file) for r in result.tombstones.collect()} == {"a/song.wav": ("exact", 1, "conversations.json"), "file-ABC123def.wav": ("none", 0, None)}
        assert result.messages.first().attachment_refs == ["song.wav"]
    assert sorted((r.source_conversation_id, r.source_index) for r in result.conversations.collect()) == [("c1", 0), ("c2", 1)]


def test_strings_of_any_depth(spark):
    deep = {"k.ey": ["a\n\"b\\", {"x": {"y": "ü: z"}, "n": 1}, ":"], "e": ""}
    frame = spark.createDataFrame([(json.dumps(deep),), ("[",), (None,)], "raw string")
    assert [r[0] for r in frame.select(all_strings(F.col("raw"))).collect()] == [["a\n\"b\\", "ü: z", ":", ""], [], []]


def test_hostile_tars_and_unknown_containers(spark, tmp_path):
    with tarfile.open(tmp_path / "e.tar.gz", "w:gz") as archive:
        info = tarfile.TarInfo("link")
        info.type, info.linkname = tarfile.SYMTYPE, "/etc/passwd"
        archive.addfile(info)
        body = tarfile.TarInfo("issues.json")
        body.size = 2
        archive.addfile(body, io.BytesIO(b"[]"))
    got = {r.path: (r.is_link, r.problem) for r in read_exports(spark, str(tmp_path / "e.tar.gz")).collect()}
    assert got == {"link": (True, "source_member_type"), "issues.json": (False, None)}
    (tmp_path / "what.bin").write_bytes(b"?")
    assert read_exports(spark, str(tmp_path / "what.bin")).first().problem == "unsupported_source_container"


def docx(body, extra=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("[Content_Types].xml", "<Types/>")
        archive.writestr("word/document.xml", body)
        for name in extra:
            archive.writestr(name, "x")
    return out.getvalue()


def test_documents(spark):
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    good = f"<w:document {space}><w:body><w:p><w:r><w:t>A</w:t><w:tab/><w:t>B</w:t></w:r></w:p><w:p><w:t>C</w:t></w:p></w:body></w:document>"
    bad = '<!DOCTYPE x [<!ENTITY e "v">]><x>&e;</x>'
    rows = [("good", docx(good)), ("dtd", docx(bad)), ("utf16", docx(bad.encode("utf-16"))), ("escape", docx(good, ["../escape.txt"])), ("long", docx(good.replace("C", "C" * 100))), ("none", b"no zip"), ("null", None)]
    got = {r.path: (r.text, r.problem) for r in extract_documents(spark.createDataFrame(rows, "path string, content binary"), max_text=64, max_entries=16).collect()}
    assert got["good"] == ("A\tB\nC\n", None)
    assert {k: v[1] for k, v in got.items() if k != "good"} == {
        "dtd": "xml_doctype_rejected", "utf16": "xml_doctype_rejected", "escape": "unsafe_inner_path", "long": "extracted_text_limit", "none": "invalid_document_container", "null": "invalid_document_container",
    }


def test_strict_json(spark):
    cases = {'{"a":1}': True, '{"a":1,"a":2}': False, "[NaN]": False, "[1": False, "[1e99999]": False, "3": True}
    frame = spark.createDataFrame([(k,) for k in cases], "raw string")
    assert {r.raw: r.ok for r in frame.select("raw", is_strict_json(F.col("raw")).alias("ok")).collect()} == cases


def test_drop_folder_is_read_once(spark, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"conversation_id":"a","role":"human","text":"x"}\nnot json\n')
    collect_folder(spark, folder, table, state).awaitTermination()
    (tmp_path / "in" / "2.jsonl").write_text('{"thread_id":5,"text":"y"}\n')
    collect_folder(spark, folder, table, state).awaitTermination()
    assert sorted((r.conversation_id, r.role, r.text) for r in spark.read.parquet(table).collect()) == [("5", None, "y"), ("a", "user", "x")]
