"""Text expressions: names, cells, timestamps, scalars of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_name(name: Column) -> Column:
    """A file name (F2): letters, digits, dot, underscore and dash stay, all else becomes an underscore; outer dots go; nothing left: unnamed."""
    kept = F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")
    trimmed = F.regexp_replace(kept, r"^\.+|\.+$", "")
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("unnamed"))


def table_cell(text: Column) -> Column:
    """A markdown table cell (F3): pipes escaped, line ends as spaces."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def rfc3339(epoch_ms: Column) -> Column:
    """Milliseconds since 1970 as UTC text (F4), with a fraction only where there is one."""
    at = F.timestamp_millis(epoch_ms)
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(epoch_ms, F.lit(1000))
    return F.concat(whole, F.when(part > 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 3, "0"))).otherwise(F.lit("")), F.lit("Z"))


def scalar_text(variant: Column) -> Column:
    """A JSON scalar as bare text (F1); objects and arrays as JSON."""
    return F.coalesce(F.try_variant_get(variant, "$", "string"), F.to_json(variant))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def alias_or_null(alias: Column, name: Column) -> Column:
    """An alias (P12), unless it is blank or only repeats the name."""
    return F.nullif(blank_to_null(alias), name)


def sorted_names(names: Column) -> Column:
    """Distinct names in order (F8)."""
    return F.array_sort(F.array_distinct(names))


def path_head(path: Column) -> Column:
    r"""The first part of a \\a\\b path (F11); none where there is a single part."""
    parts = F.filter(F.split(path, r"\\"), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))


def is_partial_time(text: Column) -> Column:
    """A date without a time of day."""
    return ~F.contains(text, F.lit("T"))


def has_altitude(coordinates: Column) -> Column:
    """Whether the third number of a coordinate text is there and not zero."""
    third = F.get(F.split(F.trim(coordinates), r"[\s,]+"), F.lit(2))
    return F.coalesce(third.try_cast("double") != 0, F.lit(False))


def attachment_name(name: Column, global_id: Column, number: Column) -> Column:
    """What an attachment is called (F14): its name, else its global id, else its number, else a word."""
    return F.coalesce(blank_to_null(name), blank_to_null(global_id), number.cast("string"), F.lit("attachment"))


def root_element(xml: Column) -> Column:
    """The root element of an XML text without its prefix (S21); declarations and comments are passed over."""
    bare = F.regexp_replace(xml, r"(?s)<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>]*>", "")
    return F.nullif(F.regexp_extract(bare, r"<(?:[\w.-]+:)?([A-Za-z_][\w.-]*)", 1), F.lit(""))


def cardinality_word(code: Column) -> Column:
    """Cardinality codes in words (F10); unknown codes stay as they are."""
    known = F.create_map(*[F.lit(x) for pair in CARDINALITIES.items() for x in pair])
    return F.coalesce(F.element_at(known, code), code)


#: Cardinality codes of relationship classes.
CARDINALITIES = {
    "esriRelCardinalityOneToOne": "one to one",
    "esriRelCardinalityOneToMany": "one to many",
    "esriRelCardinalityManyToMany": "many to many",
}


def counted(n: Column, one: str, many: str | None = None) -> Column:
    """A count with its noun."""
    return F.concat(n.cast("string"), F.when(n == 1, F.lit(f" {one}")).otherwise(F.lit(f" {many or one + 's'}")))
