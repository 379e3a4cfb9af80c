"""Scalar rules for roles, paths, references and ratios, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role names and what they count as.
ROLE_NAMES = {
    "human": "user",
    "user": "user",
    "assistant": "assistant",
    "model": "assistant",
    "grok": "assistant",
    "claude": "assistant",
    "gemini": "assistant",
    "system": "system",
    "tool": "tool",
}
# Patterns of references to attachments.  Unicode white space ends a name, as \s does there.
NAME_PATTERN = "(?U)([^/\\\\\\s\\x1c-\\x1f\"'<>]+\\.[A-Za-z0-9]{1,16})(?=$|[/\\\\\\s\\x1c-\\x1f\"'<>?#])"
ID_PATTERN = "(?iu)(?<![A-Za-z0-9_-])(?:file|asset)[-_][A-Za-z0-9]{6,}(?![A-Za-z0-9_-])"
CONVERSATION_FILE = "(?i)^conversations?(?:[-_]?([0-9]+))?\\.json$"


def normalized_role(role: Column) -> Column:
    """The role's common name; other roles keep their spelling, an empty one is null."""
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(role)), F.nullif(role, F.lit("")))


def basename(path: Column) -> Column:
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def extension(path: Column) -> Column:
    """Lower-case last suffix of the base name with its dot; a leading dot opens no suffix, a closing one is none."""
    return F.lower(F.regexp_extract(basename(path), "^.+(\\.[^.]+)$", 1))


def normalized_path(path: Column) -> Column:
    """``.`` parts and doubled or closing slashes removed."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.concat(F.when(F.startswith(path, F.lit("/")), "/").otherwise(""), F.array_join(parts, "/"))


def is_unsafe_path(path: Column) -> Column:
    """Absolute, with a backslash, a ``..`` part or a control character, or empty."""
    return (path == "") | F.rlike(path, F.lit("^/|\\\\|(^|/)\\.\\.(/|$)|[\\x00-\\x1f\\x7f]"))


def is_hex_sha256(value: Column) -> Column:
    """64 lower-case hexadecimal digits; null is none."""
    return F.coalesce(F.rlike(value, F.lit("\\A[0-9a-f]{64}\\z")), F.lit(False))


def is_sha256_reference(value: Column) -> Column:
    """``sha256:`` and a digest; null is none."""
    return F.coalesce(F.rlike(value, F.lit("\\Asha256:[0-9a-f]{64}\\z")), F.lit(False))


def sorted_unique(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))))


def reference_names(text: Column) -> Column:
    """``name:`` keys of file names that the text mentions."""
    return F.transform(F.regexp_extract_all(text, F.lit(NAME_PATTERN), F.lit(1)), lambda n: F.concat(F.lit("name:"), F.lower(n)))


def reference_ids(text: Column) -> Column:
    """``id:`` keys of file and asset ids that the text mentions."""
    return F.transform(F.regexp_extract_all(text, F.lit(ID_PATTERN), F.lit(0)), lambda n: F.concat(F.lit("id:"), F.lower(n)))


def reference_keys(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(reference_names(text), reference_ids(text))))


def path_reference_keys(path: Column) -> Column:
    """Keys under which a member can be referred to: its base name and the ids in its path."""
    return F.array_sort(F.array_distinct(F.concat(F.array(F.concat(F.lit("name:"), F.lower(basename(path)))), reference_ids(path))))


def file_number(path: Column) -> Column:
    """Number of a root-level conversation file, -1 without one, null for other names."""
    number = F.regexp_extract(path, CONVERSATION_FILE, 1)
    return F.when(F.rlike(path, F.lit(CONVERSATION_FILE)), F.when(number == "", F.lit(-1)).otherwise(number.try_cast("bigint")))


def basis_points(part: Column, whole: Column) -> Column:
    """Floor of part * 10000 / whole, null where whole is 0; negative parts round down too."""
    scaled = part.cast("bigint") * 10000
    return F.when(whole != 0, F.floor(scaled.cast("decimal(38,0)") / whole.cast("decimal(38,0)")).cast("bigint"))
