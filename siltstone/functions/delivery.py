"""Scalar rules of the notification and decision ledger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.guards import required


def notification_key(kind: Column, resource: Column, version: Column, recipient: Column, channel: Column) -> Column:
    """sha256 over the five parts; a NULL part is an error because it would change the key silently."""
    parts = [required(p, "notification key part is null") for p in (kind, resource, version, recipient, channel)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def send_outcome(code: Column) -> Column:
    """``delivered`` below 400, ``transient`` for 408, 429 and 5xx, ``permanent`` for the rest."""
    return (
        F.when(code.isin(408, 429) | (code >= 500), "transient").when(code >= 400, "permanent").otherwise("delivered")
    )
