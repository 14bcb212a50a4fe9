"""Tolerant access to JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER_KINDS = "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"
_COUNTED_KINDS = "^(BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"


def parse_line(text: Column) -> Column:
    """VARIANT of a JSON object; blank, malformed and non-object lines give null."""
    trimmed = F.trim(text)
    parsed = F.try_parse_json(trimmed)
    return F.when(trimmed.startswith("{"), parsed)


def field(event: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(event, f"$.{path}", kind)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def number_field(event: Column, path: str) -> Column:
    """Double where the JSON value itself is a number (or a boolean, counted as
    0/1); text that merely looks like a number gives null."""
    return F.when(kind_of(field(event, path)).rlike(_COUNTED_KINDS), field(event, path, "double"))


def text_field(event: Column, path: str) -> Column:
    return field(event, path, "string")


def truthy_field(event: Column, path: str) -> Column:
    """Whether a JSON value counts as set: true, a non-zero number, non-empty text."""
    kind = kind_of(field(event, path))
    as_number = field(event, path, "double")
    as_text = field(event, path, "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", field(event, path, "boolean"))
        .when(kind.rlike(_NUMBER_KINDS), as_number != 0.0)
        .when(kind == "STRING", as_text != "")
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>"),
        F.lit(False),
    )


def object_field(event: Column, path: str) -> Column:
    """The value if it is a JSON object, else null."""
    value = field(event, path)
    return F.when(kind_of(value).startswith("OBJECT"), value)


def as_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")
