"""Body text of DOCX documents."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame

# The format's namespace, and the members that a document must have.
WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
REQUIRED = ("[Content_Types].xml", "word/document.xml")


class _Refused(ValueError):
    pass


def document_text(data: bytes, max_text: int, max_entries: int, max_member: int, max_ratio: float, max_total: int = 134_217_728) -> str:
    """Text runs, tabs, breaks and paragraph ends of the body; refuses unsafe or oversized files by code."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile:
        raise _Refused("invalid_document_container") from None
    with archive:
        members = archive.infolist()
        names = [m.filename for m in members]
        if len(members) > max_entries:
            raise _Refused("inner_entry_limit")
        seen: set[str] = set()
        for m in members:
            name = m.filename
            if name.startswith(("/", "\\")) or "\\" in name or ".." in name.split("/") or any(ord(c) < 32 or ord(c) == 127 for c in name):
                raise _Refused("unsafe_inner_path")
            if m.external_attr >> 16 & 0o170000 == 0o120000:
                raise _Refused("inner_symlink")
            if m.flag_bits & 1:
                raise _Refused("encrypted_inner_member")
            if name in seen:
                raise _Refused("duplicate_inner_member")
            seen.add(name)
            if m.file_size > max_member:
                raise _Refused("inner_member_limit")
            if m.compress_size and m.file_size / m.compress_size > max_ratio:
                raise _Refused("inner_compression_ratio")
        if sum(m.file_size for m in members) > max_total:
            raise _Refused("inner_total_limit")
        if any(r not in names for r in REQUIRED):
            raise _Refused("missing_document_member")
        try:
            body = archive.read(REQUIRED[1])
        except (zipfile.BadZipFile, RuntimeError, NotImplementedError, zlib.error):
            raise _Refused("invalid_document_container") from None
    pieces: list[str] = []
    state = {"text": False, "size": 0}

    def add(text: str) -> None:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
        state["size"] += len(text.encode())
        if state["size"] > max_text:
            raise _Refused("extracted_text_limit")
        pieces.append(text)

    def opened(name: str, _: dict) -> None:
        state["text"] = name == f"{WORD} t"
        if name == f"{WORD} tab":
            add("\t")
        elif name in (f"{WORD} br", f"{WORD} cr"):
            add("\n")

    def closed(name: str) -> None:
        state["text"] = False
        if name == f"{WORD} p":
            add("\n")

    def refuse(*_) -> None:
        raise _Refused("xml_doctype_rejected")

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler, parser.EndElementHandler = opened, closed
    parser.CharacterDataHandler = lambda text: add(text) if state["text"] else None
    parser.StartDoctypeDeclHandler = parser.EntityDeclHandler = refuse
    try:
        parser.Parse(body, True)
    except expat.ExpatError:
        raise _Refused("invalid_document_xml") from None
    text = "".join(pieces)
    return text if text.endswith("\n") or not text else text + "\n"


def extract_documents(members: DataFrame, max_text: int = 33_554_432, max_entries: int = 4_096, max_member: int = 33_554_432, max_ratio: float = 200.0, max_total: int = 134_217_728) -> DataFrame:
    """path, text, problem of DOCX ``members`` (path, content); either text or problem is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, problems = [], []
            for value in batch.column("content"):
                try:
                    texts.append(document_text(value.as_py() or b"", max_text, max_entries, max_member, max_ratio, max_total))
                    problems.append(None)
                except _Refused as refused:
                    texts.append(None)
                    problems.append(str(refused))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string()), pa.array(problems, pa.string())], names=["path", "text", "problem"])

    return members.select("path", "content").mapInArrow(run, "path string, text string, problem string")
