"""Data contracts: declared columns compiled to one check expression per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import variants

REASON = "_failure_reason"
PAYLOAD = "payload"
RECORD = "_record"
MALFORMED = "malformed_json"
_CORRUPT = "_corrupt_record"

STORAGE = {"decimal": T.DoubleType(), "long": T.LongType()}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False
    minimum: float | None = None


@dataclass(frozen=True)
class Contract:
    """Columns in check order plus the quality levels the source promises."""

    source: str
    fields: tuple[Field, ...]
    max_staleness: str | None = None
    completeness: dict[str, float] = field(default_factory=dict)
    topic: str | None = None

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, STORAGE.get(f.kind, T.StringType())) for f in self.fields])


def load_contract(path: str) -> Contract:
    """Read a contract in its YAML form."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        document = yaml.safe_load(handle)
    quality = document.get("quality") or {}
    columns = document["schema"]["columns"]
    return Contract(
        source=document["metadata"]["name"],
        fields=tuple(
            Field(c["name"], c["type"], bool(c.get("required")), (c.get("constraints") or {}).get("minimum"))
            for c in columns
        ),
        max_staleness=(quality.get("freshness") or {}).get("maxStaleness"),
        completeness=dict(quality.get("completeness") or {}),
        topic=document["schema"].get("topic"),
    )


def _field_reason(f: Field, strict: bool) -> Column:
    value = F.col(RECORD)[f.name]
    missing = variants.is_missing(value)
    reason = F.when(missing, F.lit(f"null_violation:{f.name}") if f.required else F.lit(None).cast("string"))
    reason = reason.when(~variants.type_matches(value, f.kind, strict), F.lit(f"type_mismatch:{f.name}"))
    if f.minimum is not None:
        low = variants.as_double(value) < F.lit(float(f.minimum))
        if f.kind not in ("decimal", "long"):
            low = variants.is_number(value) & low
        reason = reason.when(low, F.lit(f"constraint_violation:{f.name}"))
    return reason


def _computed_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column behind a generator, so that filters above do not repeat its expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def check(df: DataFrame, contract: Contract, payload: str = PAYLOAD, strict: bool = False) -> DataFrame:
    """Add the parsed record and the first failing rule of each JSON text in ``payload``.

    Fields are tried in contract order, within a field: null, type, minimum. Text that is
    not a JSON object is kept with its own reason. Each text is parsed once, only the
    declared fields are read, and there is no shuffle.
    """
    names = T.StructType([T.StructField(f.name, T.VariantType()) for f in contract.fields])
    schema = names.add(_CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = _computed_once(df, F.from_json(payload, schema, options), RECORD)
    record = F.col(RECORD)
    malformed = F.coalesce(record[_CORRUPT].isNotNull() | ~F.rlike(payload, F.lit(r"^\s*\{")), F.lit(True))
    first = F.coalesce(*[_field_reason(f, strict) for f in contract.fields])
    return _computed_once(parsed, F.when(malformed, MALFORMED).otherwise(first), REASON)


def typed_columns(contract: Contract) -> list[Column]:
    return [variants.typed(F.col(RECORD)[f.name], f.kind).alias(f.name) for f in contract.fields]


def split(checked: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Valid rows with typed columns, the full record kept as JSON text, and rejected rows.

    Both sides are filters over one checked frame; a writer that needs both in one pass
    uses :func:`siltstone.sources.lake.write_checked`.
    """
    valid = checked.where(F.col(REASON).isNull()).select(*keep, *typed_columns(contract), PAYLOAD)
    rejected = checked.where(F.col(REASON).isNotNull()).select(*keep, REASON, PAYLOAD)
    return valid, rejected


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per outcome; accepted rows count under ``accepted``."""
    return checked.groupBy(F.coalesce(REASON, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("rows"))


def is_additive(old: Contract, new: Contract) -> bool:
    """Additive-only evolution: every old field is unchanged and new fields are optional."""
    now = {f.name: f for f in new.fields}
    before = {f.name for f in old.fields}
    unchanged = all(now.get(f.name) == f for f in old.fields)
    return unchanged and not any(f.required for f in new.fields if f.name not in before)
