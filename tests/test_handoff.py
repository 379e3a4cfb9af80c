"""Documents and what becomes of them, candidates, their check, and the staging of what a decision accepts."""

from __future__ import annotations

import hashlib
import io
import json
import os
import zipfile

import pytest
from ledgerloom.functions.privacy import RULES, rule_hashes
from ledgerloom.operators.members import RuleViolation
from ledgerloom.plans.documents import READABLE, DocumentPolicy, document_texts, retained, settled_documents
from ledgerloom.plans.handoff import artifacts_of, candidate_manifest, stage
from ledgerloom.sources.docx import extract_documents
from ledgerloom.sources.json_lines import candidate_rows

SPACE = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
BODY = f"<w:document {SPACE}><w:body><w:p><w:r><w:t>A</w:t></w:r></w:p></w:body></w:document>"


def docx(body=BODY, extra=(), link=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("[Content_Types].xml", "<Types/>")
        archive.writestr("word/document.xml", body)
        for name, text in extra:
            archive.writestr(name, text)
        if link:
            info = zipfile.ZipInfo(link)
            info.external_attr = 0o120777 << 16
            archive.writestr(info, "/etc/passwd")
    return out.getvalue()


def test_inner_guards_have_a_code_each(spark):
    torn = bytearray(docx())
    torn[torn.index(b"word/document.xml") + 25] ^= 255
    rows = [
        ("fine", docx(), "A\n", None), ("returns", docx(BODY.replace("A", "x&#13;&#10;y&#13;z")), "x\n\ny\nz\n", None), ("control", docx(extra=[("a\x07b", "x")]), None, "unsafe_inner_path"),
        ("link", docx(link="l"), None, "inner_symlink"), ("large", docx(extra=[("big", os.urandom(3000))]), None, "inner_member_limit"), ("dense", docx(extra=[("d", "0" * 1900)]), None, "inner_compression_ratio"),
        ("total", docx(extra=[("e", os.urandom(1500)), ("f", os.urandom(1500))]), None, "inner_total_limit"), ("torn", bytes(torn), None, "invalid_document_container"),
    ]
    got = extract_documents(spark.createDataFrame([r[:2] for r in rows], "path string, content binary"), max_member=2000, max_total=2500, max_ratio=40.0)
    assert {r.path: (r.text, r.problem) for r in got.collect()} == {r[0]: r[2:] for r in rows}


@pytest.mark.parametrize(
    "policy, expected",
    [
        (DocumentPolicy(), {"good": ("extract", "document_text_extracted"), "bad": ("keep", "document_retained_no_frozen_extraction"), "pdf": ("keep", "document_retained_no_frozen_extraction")}),
        (DocumentPolicy(by_cause=True), {"good": ("extract", "document_text_extracted"), "bad": ("keep", "document_retained_extractor_error"), "pdf": ("keep", "document_retained_no_frozen_extractor")}),
        (DocumentPolicy(extract_text=False, by_cause=True), dict.fromkeys(["good", "bad", "pdf"], ("keep", "document_retained_text_extraction_disabled"))),
        (DocumentPolicy(max_extract=1, by_cause=True), {"good": ("keep", "document_retained_over_extract_limit"), "bad": ("keep", "document_retained_over_extract_limit"), "pdf": ("keep", "document_retained_no_frozen_extractor")}),
        (DocumentPolicy(keep_under=1), {"good": ("extract", "document_text_extracted"), "bad": ("tombstone", "document_over_retention_limit"), "pdf": ("tombstone", "document_over_retention_limit")}),
    ],
)
def test_documents_fall_back_with_a_reason(spark, policy, expected):
    rows = [("good", docx(), READABLE), ("bad", b"no zip", READABLE), ("pdf", b"%PDF-", "application/pdf")]
    decided = spark.createDataFrame([(p, c, m, len(c), "extract", "policy") for p, c, m in rows] + [("n", b"x", None, 1, "reject", "policy")], "path string, content binary, media_type string, size_bytes long, decision string, reason string")
    texts = document_texts(decided, policy)
    settled = settled_documents(decided, texts, policy)
    assert {r.path: (r.decision, r.reason) for r in settled.collect()} == expected | {"n": ("reject", "policy")}
    assert {r.path for r in retained(settled, policy).collect()} == {p for p, (d, _) in expected.items() if d == "keep" or d == "extract" and policy.keep_under > 1}


def candidate(folder):
    for name, text in {"messages/part-0": "m\n", "retained/a b.txt": "kept", "x.json": "{}"}.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (folder / "candidate").mkdir()
    (folder / "candidate" / "part-0").write_text("a review record")
    return str(folder)


def files(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if f[:1] not in "._"}


def test_accepted_artifacts_are_staged_and_nothing_else(spark, tmp_path):
    root = candidate(tmp_path / "c")
    declared = artifacts_of(spark, root)
    assert sorted(r.path for r in declared.collect()) == ["messages/part-0", "retained/a b.txt", "x.json"]
    row = candidate_manifest(declared, source_type="s", profile="p").first()
    listed = "[" + ",".join(json.dumps({"path": r.path, "sha256": r.sha256, "size_bytes": r.size_bytes}, separators=(",", ":")) for r in sorted(declared.collect())) + "]\n"
    assert (row.artifacts, row.total_bytes, row.source_type, row.artifacts_sha256) == (3, 8, "s", hashlib.sha256(listed.encode()).hexdigest())
    decide = lambda *rows: spark.createDataFrame(rows, "path string, disposition string, reason string")
    decisions = decide(("messages/part-0", "accept", None), ("retained/a b.txt", "accept", None), ("x.json", "reject", "no need"))
    out = tmp_path / "out"
    stage(declared, decisions, root, str(out))
    assert (out / "accepted" / "retained" / "a b.txt").read_text() == "kept" and not (out / "accepted" / "x.json").exists()
    entries = [json.loads(r.value) for r in spark.read.text(f"{out}/pack").collect()]
    assert [(e["logical_path"], e["source_path"], e["privacy_class"]) for e in entries] == [
        ("import-candidate/artifacts/messages/part-0", "accepted/messages/part-0", "RESTRICTED"), ("import-candidate/artifacts/retained/a b.txt", "accepted/retained/a b.txt", "RESTRICTED"),
    ]
    assert spark.read.json(f"{out}/review/summary").first().summary == "partially_accepted"
    before = files(out)
    for wrong, code in [
        (decide(("x.json", "accept", None)), "artifact_without_decision"), (decisions.unionByName(decide(("y", "reject", "r"))), "decision_without_artifact"),
        (decisions.unionByName(decide(("x.json", "accept", None))), "decided_twice"), (decide(("messages/part-0", "maybe", None), ("retained/a b.txt", "accept", None), ("x.json", "accept", None)), "invalid_disposition"),
    ]:
        with pytest.raises(RuleViolation, match=code):
            stage(declared, wrong, root, str(out), replace=True)
    kept = declared.collect()
    (tmp_path / "c" / "x.json").write_text("[]")
    for rows, code in [(kept, "artifact_hash_mismatch"), ([r for r in kept if r.path != "x.json"], "candidate_tree_mismatch")]:
        with pytest.raises(RuleViolation, match=code):
            stage(spark.createDataFrame(rows, declared.schema), decisions, root, str(out), replace=True)
    with pytest.raises(ValueError, match="privacy_class"):
        stage(declared, decisions, root, str(out), privacy_class="SECRET")
    with pytest.raises(FileExistsError):
        stage(artifacts_of(spark, root), decisions, root, str(out))
    assert files(out) == before and sorted(p.name for p in tmp_path.iterdir()) == ["c", "out"]


def test_candidate_lines_are_objects_of_bounded_files(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a":1}\n\n{"b":[2]}\n')
    assert [(r.line, str(r.d)) for r in candidate_rows(spark, str(path)).orderBy("line").collect()] == [(1, '{"a":1}'), (3, '{"b":[2]}')]
    for text, code, subject in [('{"a":1}\n[2]\n', "invalid_jsonl_shape", ":2"), ('\n{"a":1,"a":2}\n', "invalid_jsonl", ":2"), ("{\n", "invalid_jsonl", ":1")]:
        path.write_text(text)
        with pytest.raises(RuleViolation, match=f"{code}.*{subject}$"):
            candidate_rows(spark, str(path))
    path.write_text('{"a":1}\n')
    with pytest.raises(RuleViolation, match="jsonl_size_limit"):
        candidate_rows(spark, str(path), max_bytes=3)


def test_rules_have_hashes_of_their_own_and_one_together(spark):
    got = {r.rule_id: (r.rule_sha256, r.ruleset_sha256) for r in rule_hashes(spark).collect()}
    bodies = [json.dumps({"category": c, "pattern": p, "rule_id": i}, separators=(",", ":")) for i, c, p in RULES]
    whole = hashlib.sha256(('{"rules":[' + ",".join(bodies) + "]}\n").encode()).hexdigest()
    assert got == {i: (hashlib.sha256((b + "\n").encode()).hexdigest(), whole) for (i, *_), b in zip(RULES, bodies)}
    assert rule_hashes(spark, RULES[1:]).first().ruleset_sha256 != whole
