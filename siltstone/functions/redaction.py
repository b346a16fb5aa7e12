"""Redaction of sensitive fields in typed columns and in free-form JSON."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key pattern, bearer pattern and the replacement texts.
SENSITIVE_KEY = r"(authorization|cookie|password|secret|token|api[_-]?key|email)"
BEARER = r"Bearer\s+[A-Za-z0-9._~+/=-]+"
MASK = "[REDACTED]"
BEARER_MASK = "Bearer [REDACTED]"
MALFORMED = "malformed_json"

_KEY = re.compile(SENSITIVE_KEY, re.IGNORECASE)
_BEARER = re.compile(BEARER, re.IGNORECASE)


def mask_bearer(text: Column) -> Column:
    return F.regexp_replace(text, f"(?Ui){BEARER}", BEARER_MASK)


def mask_column(value: Column, kind: T.DataType, key: str = "") -> Column:
    """Rebuild a typed column with its sensitive parts masked; the schema steers the walk.

    A sensitive field becomes a string. A map cannot mix types, so masked maps whose
    values are not strings carry their values as JSON text.
    """
    if _KEY.search(key):
        return F.lit(MASK)
    if isinstance(kind, T.StringType):
        return mask_bearer(value)
    if isinstance(kind, T.VariantType):  # of unknown shape, like free-form JSON
        return F.parse_json(redact_json(F.to_json(value)))
    if isinstance(kind, T.StructType):
        fields = [mask_column(value.getField(f.name), f.dataType, f.name).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: mask_column(item, kind.elementType))
    if isinstance(kind, T.MapType):
        def entry(k: Column, v: Column) -> Column:
            kept = mask_column(v, kind.valueType)
            if not isinstance(kind.valueType, T.StringType):
                kept = F.to_json(kept) if isinstance(kind.valueType, _NESTED) else kept.cast("string")
            return F.when(F.rlike(k, F.lit(f"(?i){SENSITIVE_KEY}")), F.lit(MASK)).otherwise(kept)

        return F.transform_values(value, entry)
    return value


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def redact_columns(df: DataFrame) -> DataFrame:
    """Mask every column of a frame by its schema."""
    return df.select(*[mask_column(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields])


def _clean(value):
    if isinstance(value, str):
        return _BEARER.sub(BEARER_MASK, value)
    return [_clean(v) for v in value] if isinstance(value, list) else value


def _mask_pairs(pairs):
    return {k: MASK if _KEY.search(k) else _clean(v) for k, v in pairs}


def _masked(text: str | None) -> tuple[str | None, str | None]:
    if text is None:
        return None, None
    try:
        return json.dumps(_clean(json.loads(text, object_pairs_hook=_mask_pairs)), ensure_ascii=False), None
    except (ValueError, RecursionError):  # no JSON, or nested beyond reason
        return MASK, MALFORMED


_CHECKED = T.StructType([T.StructField("masked", T.StringType()), T.StructField("reason", T.StringType())])


@F.pandas_udf(_CHECKED)
def redact_json_checked(texts: pd.Series) -> pd.DataFrame:
    """Mask JSON text of unknown shape, row by row: the parser calls the hook innermost object first.

    Text that cannot be read is masked as a whole and has a reason; NULL stays NULL.
    """
    return pd.DataFrame([_masked(t) for t in texts], columns=["masked", "reason"], dtype=object)


def redact_json(text: Column | str) -> Column:
    """The masked text alone."""
    return redact_json_checked(text)["masked"]
