"""Kind, media type and disposition of a member from its first bytes, its extension and the policy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions of each kind where no signature is known.
EXTENSIONS = {
    "structured_text": (
        ".json .jsonl .txt .md .markdown .csv .tsv .html .htm .xml .yaml .yml .toml .ini .cfg .log .py .js .ts .tsx .jsx .css .scss .c .h .cc .cpp"
        " .hpp .rs .go .java .kt .kts .swift .sh .bash .zsh .fish .ps1 .sql .lean .adb .ads .f .f90 .f95 .cob .cbl"
    ).split(),
    "document": ".pdf .docx .pptx .odt .ods .odp .rtf".split(),
    "audio": ".wav .wave .mp3 .m4a .aac .flac .ogg .opus .aiff .aif".split(),
    "video": ".mp4 .mov .m4v .webm .mkv .avi .mpeg .mpg".split(),
    "image": ".png .jpg .jpeg .gif .webp .bmp .tif .tiff .svg".split(),
    "executable": ".exe .dll .so .dylib .msi .apk .appimage .bin".split(),
    "archive": ".zip .tar .tgz .gz .bz2 .xz .7z .rar".split(),
}
# Documents that are zip files inside.
ZIP_DOCUMENTS = {
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".odt": "application/vnd.oasis.opendocument.text",
    ".ods": "application/vnd.oasis.opendocument.spreadsheet",
    ".odp": "application/vnd.oasis.opendocument.presentation",
}
# Signatures as (offset from 0, hex digits, kind, media type), the first that fits counts.
EARLY_SIGNATURES = [
    (0, "664C6143", "audio", "audio/flac"),
    (0, "4F676753", "audio", "audio/ogg"),
    (0, "494433", "audio", "audio/mpeg"),
]
LATE_SIGNATURES = [
    (0, "89504E470D0A1A0A", "image", "image/png"),
    (0, "FFD8FF", "image", "image/jpeg"),
    (0, "474946383761", "image", "image/gif"),
    (0, "474946383961", "image", "image/gif"),
    (0, "255044462D", "document", "application/pdf"),
    (0, "7F454C46", "executable", "application/x-elf"),
    (0, "4D5A", "executable", "application/vnd.microsoft.portable-executable"),
]
ARCHIVE_SIGNATURES = [
    (0, "1F8B", "archive", "application/gzip"),
    (0, "425A68", "archive", "application/x-bzip2"),
    (0, "FD377A585A00", "archive", "application/x-xz"),
    (0, "377ABCAF271C", "archive", "application/x-7z-compressed"),
    (0, "526172211A07", "archive", "application/vnd.rar"),
    (257, "7573746172", "archive", "application/x-tar"),
]
# Why a kind is treated as it is.
REASONS = {
    "audio": "media_policy",
    "video": "media_policy",
    "image": "image_size_policy",
    "document": "document_policy",
    "structured_text": "structured_text_policy",
    "executable": "executable_policy",
    "archive": "nested_archive_policy",
    "unknown": "opaque_size_policy",
}


@dataclass(frozen=True)
class Policy:
    """What happens to each kind; sizes are inclusive limits for keeping."""

    audio: str = "tombstone"
    video: str = "tombstone"
    structured_text: str = "keep"
    image_bytes: int = 10_485_760
    opaque_bytes: int = 1_048_576

    def __post_init__(self):
        allowed = {"keep", "extract", "tombstone", "reject"}
        if not {self.audio, self.video, self.structured_text} <= allowed:
            raise ValueError(f"a policy decision must be one of {sorted(allowed)}")


def _kind(kind: str, media: str | Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), (F.lit(media) if isinstance(media, str) else media).alias("media_type"))


def sniffed(head: Column, ext: Column) -> Column:
    """(kind, media_type) by signature, or null.  Signatures are compared as hex digits of the leading bytes."""
    digits = F.hex(head)
    at = lambda offset, hexes: F.substring(digits, 2 * offset + 1, len(hexes)) == hexes
    brand = F.lower(F.substring(head, 9, 4).cast("string"))
    out = F.when(at(0, "52494646") & at(8, "57415645"), _kind("audio", "audio/wav"))
    for offset, hexes, kind, media in EARLY_SIGNATURES:
        out = out.when(at(offset, hexes), _kind(kind, media))
    out = out.when(F.rlike(digits, F.lit("^FF[EF]")), _kind("audio", "audio/mpeg"))
    mp4 = at(4, "66747970") & (F.length(head) >= 12)
    out = out.when(mp4 & (ext.isin(".m4a", ".aac") | brand.isin("m4a ", "m4b ", "f4a ")), _kind("audio", "audio/mp4")).when(mp4, _kind("video", "video/mp4"))
    out = out.when(at(0, "1A45DFA3"), _kind("video", F.when(ext == ".webm", "video/webm").otherwise("video/x-matroska")))
    for offset, hexes, kind, media in LATE_SIGNATURES:
        out = out.when(at(offset, hexes), _kind(kind, media))
    zipped = F.create_map(*[F.lit(x) for pair in ZIP_DOCUMENTS.items() for x in pair])
    inside = F.try_element_at(zipped, ext)
    out = out.when(at(0, "504B0304"), F.when(inside.isNotNull(), _kind("document", inside)).otherwise(_kind("archive", "application/zip")))
    for offset, hexes, kind, media in ARCHIVE_SIGNATURES:
        out = out.when(at(offset, hexes), _kind(kind, media))
    return out


def classified(head: Column, ext: Column) -> Column:
    """(kind, media_type): by signature, else by extension, else unknown."""
    out = F.when(F.lit(False), _kind("unknown", ""))
    for kind, extensions in EXTENSIONS.items():
        out = out.when(ext.isin(extensions), _kind(kind, "text/plain" if kind == "structured_text" else "application/octet-stream"))
    return F.coalesce(sniffed(head, ext), out.otherwise(_kind("unknown", "application/octet-stream")))


def disposition(kind: Column, size_bytes: Column, policy: Policy = Policy()) -> Column:
    """(decision, reason) of a kind and size."""
    limited = lambda limit: F.when(size_bytes <= limit, "keep").otherwise("tombstone")
    decision = (
        F.when(kind == "audio", policy.audio)
        .when(kind == "video", policy.video)
        .when(kind == "image", limited(policy.image_bytes))
        .when(kind == "document", "extract")
        .when(kind == "structured_text", policy.structured_text)
        .when(kind.isin("executable", "archive"), "reject")
        .otherwise(limited(policy.opaque_bytes))
    )
    reasons = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return F.struct(decision.alias("decision"), F.element_at(reasons, kind).alias("reason"))
