"""JSON of any shape as VARIANT: objects merged with their types kept, and values told by kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT, LIST = "map<string,variant>", "array<variant>"


def as_object(value: Column) -> Column:
    """The members of an object; null for every other value."""
    return F.try_variant_get(value, "$", OBJECT)


def as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", LIST)


def kind(value: Column) -> Column:
    """``object``, ``list``, ``text``, ``boolean``, ``number``, ``null``; null where there is no value."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    known = {"OBJECT": "object", "ARRAY": "list", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null", **dict.fromkeys(("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), name)


def member(value: Column, name: str) -> Column:
    """A member of an object as it is, null if it has none of that name; the other members are not touched.  ``name`` holds no quote."""
    return F.try_variant_get(value, f"$['{name}']", "variant")


def text(value: Column) -> Column:
    """A text that holds more than blanks; null for every other value."""
    words = F.when(kind(value) == "text", F.try_variant_get(value, "$", "string"))
    return F.when(F.trim(words) != "", words)


def merged(left: Column, right: Column, depth: int = 4) -> Column:
    """Two variants as one: objects member by member, down to ``depth`` levels, else the right one, unless it is not there.

    A JSON null is a value and wins; lists are not merged.  Beyond ``depth`` the
    right object stands for both.
    """
    if not depth:
        return F.coalesce(right, left)
    both = (kind(left) == "object") & (kind(right) == "object")
    members = F.map_zip_with(as_object(left), as_object(right), lambda _, a, b: merged(a, b, depth - 1))
    return F.when(both, F.to_variant_object(members)).otherwise(F.coalesce(right, left))


def json_merge(left: Column, right: Column, depth: int = 1) -> Column:
    """JSON texts of objects merged, names in order, values of every type as they are; a null is an empty object.

    Malformed JSON and a name that repeats in an object fail.  A number keeps
    its value but not how it was written: ``2.50`` is read as ``2.5``.
    """
    read = lambda c: F.parse_json(F.coalesce(c, F.lit("{}")))
    return F.to_json(merged(read(left), read(right), depth))
