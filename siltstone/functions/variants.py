"""Type tests on raw JSON values held as VARIANT.

A JSON number may arrive as BIGINT, DECIMAL(p,s) or DOUBLE. An integer wider than 64 bits arrives
as DECIMAL(p>=19,0): its column could not store it, so it does not pass as ``long``; ``2.0``
arrives as DECIMAL(1,0) and does not either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = "BIGINT"
_NUMBER = r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*"
_BOOLEAN = r"|BOOLEAN"


def is_missing(value: Column) -> Column:
    """SQL NULL (the field is absent) or a JSON null."""
    return value.isNull() | F.is_variant_null(value)


def type_matches(value: Column, kind: str, strict: bool = False) -> Column:
    """Whether a present value has the declared kind. Unknown kinds always match.

    Booleans pass the numeric kinds unless ``strict``: the declared checks treat a
    boolean as an integer.
    """
    boolean = "" if strict else _BOOLEAN
    patterns = {"string": "STRING", "timestamp": "STRING", "long": _INTEGER + boolean, "decimal": _NUMBER + boolean}
    if kind not in patterns:
        return F.lit(True)
    return F.schema_of_variant(value).rlike(f"^({patterns[kind]})$")


def is_number(value: Column) -> Column:
    return F.schema_of_variant(value).rlike(f"^({_NUMBER}{_BOOLEAN})$")


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def typed(value: Column, kind: str) -> Column:
    """Read a checked value into its storage type."""
    if kind == "decimal":
        return as_double(value)
    if kind == "long":
        return F.try_variant_get(value, "$", "bigint")
    return F.try_variant_get(value, "$", "string")
