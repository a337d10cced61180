"""JSON paths with types told apart: the text "true" is not the boolean true."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(c: Column) -> Column:
    """A variant, or null where the text is no JSON."""
    return F.try_parse_json(c)


def path_type(variant: Column, path: str) -> Column:
    """BOOLEAN, BIGINT, STRING, ARRAY<...>, OBJECT<...> ... of what a path holds; null if it is missing."""
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def path_text(variant: Column, path: str) -> Column:
    return F.try_variant_get(variant, path, "string")


def is_json_bool(variant: Column, path: str, value: bool) -> Column:
    """Whether a path holds the JSON boolean ``value``; never null."""
    found = F.when(path_type(variant, path) == "BOOLEAN", F.try_variant_get(variant, path, "boolean"))
    return F.coalesce(found == F.lit(value), F.lit(False))


def array_length(variant: Column, path: str) -> Column:
    """Length of a JSON array; 0 for anything else."""
    return F.coalesce(F.size(F.try_variant_get(variant, path, "array<variant>")), F.lit(0))
