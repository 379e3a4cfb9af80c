"""Strict JSON values and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_strict_json(text: Column) -> Column:
    """Whether ``text`` is one JSON value without repeated keys, NaN or Infinity."""
    return F.try_parse_json(text).isNotNull() & ~F.rlike(text, F.lit("[:,\\[]\\s*-?[0-9]+(?:\\.[0-9]+)?[eE]\\+?[0-9]{4,}"))


def json_text(content: Column) -> Column:
    """The text of JSON bytes in UTF-8, UTF-16 or UTF-32, with or without a byte order mark; null where UTF-8 is broken.

    Without a mark the zeros among the first bytes tell: JSON begins with an ASCII character."""
    head, n = F.hex(F.substring(content, 1, 4)), F.octet_length(content)
    utf8 = lambda c: F.try_validate_utf8(c.cast("string"))
    rest, zero = F.substring(content, F.lit(4), n), lambda i: F.substring(head, 2 * i + 1, 2) == "00"
    long = n >= 4
    return (
        F.when(F.startswith(head, F.lit("0000FEFF")) | F.startswith(head, F.lit("FFFE0000")), F.decode(content, "UTF-32"))
        .when(F.startswith(head, F.lit("FEFF")) | F.startswith(head, F.lit("FFFE")), F.decode(content, "UTF-16"))
        .when(F.startswith(head, F.lit("EFBBBF")), utf8(rest))
        .when(long & zero(0) & zero(1), F.decode(content, "UTF-32"))
        .when((long | (n == 2)) & zero(0), F.decode(content, "UTF-16BE"))
        .when(long & zero(1) & zero(2) & zero(3), F.decode(F.concat(F.lit(bytes([255, 254, 0, 0])), content), "UTF-32"))
        .when((long | (n == 2)) & zero(1), F.decode(content, "UTF-16LE"))
        .otherwise(utf8(content))
    )


def is_list(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))


def number_text(v: Column) -> Column:
    """A VARIANT number as it was written, by its value: whole numbers by their digits, others as the shortest decimal that is the same
    double, with ``.0`` where nothing follows the point and an exponent below 0.0001 and from 1e16 on (of subnormal doubles as the JVM
    shortens them)."""
    x, own = v.cast("double"), F.schema_of_variant(v)
    # whole numbers of up to 18 digits are BIGINT, so a DECIMAL of that size had a point
    whole = F.startswith(own, F.lit("BIGINT")) | F.rlike(own, F.lit("^(INT|SMALLINT|TINYINT)|^DECIMAL\\((19|2[0-9]|3[0-9]),0\\)"))
    plain = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,20)").cast("string"), "0+$", ""), "\\.$", ".0")
    parts = [F.regexp_extract(x.cast("string"), "^(-?[0-9]+)(\\.[0-9]+)?E(-?)([0-9]+)$", i) for i in range(1, 5)]
    exponent = F.concat(parts[0], F.when(parts[1] == ".0", "").otherwise(parts[1]), F.lit("e"), F.when(parts[2] == "-", "-").otherwise("+"), F.when(F.length(parts[3]) < 2, F.lpad(parts[3], 2, "0")).otherwise(parts[3]))
    small = (x != 0) & (F.abs(x) < 1e-4)
    return F.when(whole, v.cast("string")).when(small | (F.abs(x) >= 1e16), exponent).otherwise(plain)


def elements(text: Column, *keys: str) -> Column:
    """JSON texts of a top-level list's elements, or of the list under the first of ``keys`` that has one; null for other shapes."""
    under = [F.get_json_object(text, f"$.{key}") for key in keys or ("conversations",)]
    inner = F.coalesce(*(F.when(F.rlike(v, F.lit("^\\s*\\[")), v) for v in under))
    return F.when(F.rlike(text, F.lit("^\\s*\\[")), F.from_json(text, "array<string>")).when(F.rlike(inner, F.lit("^\\s*\\[")), F.from_json(inner, "array<string>"))


def variants(text: Column, *keys: str) -> Column:
    """The same elements as VARIANT values, which keep the digits of their numbers."""
    whole = F.try_parse_json(text)
    under = [F.try_variant_get(whole, f"$.{key}", "variant") for key in keys or ("conversations",)]
    inner = F.coalesce(*(F.when(is_list(v), v) for v in under))
    return F.try_variant_get(F.when(is_list(whole), whole).otherwise(inner), "$", "array<variant>")


def exploded(payloads: DataFrame, *keys: str) -> DataFrame:
    """source_path, source_index, raw, d of the elements of ``payloads`` (source_path, raw): ``d`` as VARIANT, for values; ``raw`` as text,
    for the order of keys."""
    both = F.arrays_zip(elements(F.col("raw"), *keys).alias("raw"), variants(F.col("raw"), *keys).alias("d"))
    return payloads.select("source_path", F.posexplode(both).alias("source_index", "e")).select("source_path", "source_index", "e.raw", "e.d")


def json_lines(payloads: DataFrame) -> DataFrame:
    """source_path, source_index, raw of the lines of ``payloads``; blank lines are left out but keep no number."""
    lines = F.filter(F.split("raw", "\r\n|\n|\r"), lambda line: F.trim(line) != "")
    return payloads.select("source_path", F.posexplode(lines).alias("source_index", "raw"))


def numbered_lines(payloads: DataFrame) -> DataFrame:
    """source_path, line, raw of the lines with text of ``payloads``; lines count from 1, blank ones included."""
    lines = payloads.select("source_path", F.posexplode(F.split("raw", "\r\n|\n|\r")).alias("line", "raw"))
    return lines.where(F.trim("raw") != "").withColumn("line", F.col("line") + 1)


def all_strings(text: Column) -> Column:
    """Every string value of a JSON text at any depth, keys left out, in order."""
    quoted = F.regexp_extract_all(text, F.lit('"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"(?:\\s*+:)?'), F.lit(0))
    values = F.filter(quoted, lambda s: ~F.endswith(s, F.lit(":")))
    return F.coalesce(F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>"), F.array().cast("array<string>"))


def allowed_fields(text: Column, fields: list[str]) -> Column:
    """The top-level fields of an object that are on the list, as JSON with sorted keys; values keep their JSON type, numbers their value."""
    kept = F.map_filter(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"), lambda k, _: k.isin(fields))
    entries = F.array_sort(F.map_entries(kept), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.to_json(F.map_from_entries(entries))
