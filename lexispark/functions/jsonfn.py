"""JSON accessors and per-record error capture.

All of these are JVM-side expressions over Spark's VARIANT type, so they stay
inside whole-stage code generation and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import col

# Message put in the ``error`` column of a line that is not valid JSON.
PARSE_ERROR = "malformed JSON line"


def parse(line) -> Column:
    """A2: parse a JSON text line into a VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(col(line))


def _field(v: Column, field: str) -> Column:
    return F.variant_get(v, _path(field), "variant")


def _path(field: str) -> str:
    if field in ("", "$"):
        return "$"
    return "$." + field if not field.startswith("$") else field


def value_type(v, field: str = "$") -> Column:
    """Type name of a JSON value (``STRING``, ``BIGINT``, ``DECIMAL(..)`` ...)."""
    return F.schema_of_variant(_field(col(v), field))


def string_field(v, field: str = "$") -> Column:
    """B1: the value when it is a JSON string, else ``""`` (also when missing,
    null, a number, an object or an array)."""
    v = col(v)
    return F.when(value_type(v, field) == F.lit("STRING"),
                  F.try_variant_get(v, _path(field), "string")).otherwise(F.lit(""))


def int_field(v, field: str = "$") -> Column:
    """B2: the value when it is a JSON integer that fits in 32 bits, else 0.
    ``5.0`` and ``"5"`` both give 0."""
    v = col(v)
    as_int = F.try_variant_get(v, _path(field), "int")
    return F.when(value_type(v, field) == F.lit("BIGINT"), F.coalesce(as_int, F.lit(0))) \
        .otherwise(F.lit(0))


def long_field(v, field: str = "$") -> Column:
    """A count: the value when it is a JSON integer of 64 bits, else 0."""
    v = col(v)
    as_long = F.try_variant_get(v, _path(field), "bigint")
    return F.when(value_type(v, field) == F.lit("BIGINT"), F.coalesce(as_long, F.lit(0))).otherwise(F.lit(0))


def body(line) -> Column:
    """Comment body of a JSON line."""
    return string_field(parse(line), "body")


def error_of(line) -> Column:
    """NULL for a line that parses, else the error message."""
    return F.when(parse(line).isNull(), F.lit(PARSE_ERROR))


def merge_fields(line: str, fields) -> Column:
    """Add the columns named in ``fields`` to the JSON object held in the
    column ``line``; unknown fields are kept and same-name fields are
    overwritten by the new value. Returns the merged JSON text (keys come back
    sorted). NULL when the line is not a JSON object. Old same-name keys are
    dropped before the concat, so no map-key dedup policy is needed."""
    names = ", ".join(f"'{f}'" for f in fields)
    pairs = ", ".join(f"'{f}', CAST(`{f}` AS VARIANT)" for f in fields)
    return F.expr(
        f"to_json(map_concat("
        f"map_filter(try_cast(try_parse_json(`{line}`) AS MAP<STRING, VARIANT>), "
        f"(k, v) -> NOT array_contains(array({names}), k)), map({pairs})))")
