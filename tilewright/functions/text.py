"""Names and keys of slides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def slide_id(path: Column) -> Column:
    """Base name without its last extension; a name that is only an extension stays; empty: `slide`."""
    name = base_name(path)
    stem = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)
    return F.coalesce(F.nullif(F.when(stem == "", name).otherwise(stem), F.lit("")), F.lit("slide"))


def slide_key(path: Column) -> Column:
    """Path as a join key: the older scheme of cloud paths is written as the usual one."""
    return F.regexp_replace(F.trim(path), "^gcs://", "gs://")


def is_remote(path: Column) -> Column:
    return F.contains(path, F.lit("://"))


def short_hash(path: Column) -> Column:
    return F.substring(F.sha1(path), 1, 8)


def clean(value: Column) -> Column:
    """Trimmed text; blank and `nan` are null."""
    v = F.trim(value.cast("string"))
    return F.when((v != "") & (F.lower(v) != "nan"), v)


def stain_name(stain: Column) -> Column:
    return F.lower(F.trim(stain))


def error_class(message: Column) -> Column:
    """`SomeError` of `SomeError: text`; null where a message begins otherwise."""
    found = F.regexp_extract(message, r"^([A-Z][A-Za-z0-9_]*(?:Error|Exception|Interrupt|Exit|Warning)):", 1)
    return F.nullif(found, F.lit(""))


def fill(template: Column, values: dict[str, Column]) -> Column:
    """template with each {name} replaced."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def dig(document: Column, dotted: str) -> Column:
    """Text of the value at a dotted path in a JSON document, or null."""
    return F.get_json_object(document, "$." + dotted)
