"""Text expressions: decoding, windows over characters, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT = "�"
# A noncharacter that stands in for replacement characters already present in the input.
PLACEHOLDER = "﷐"
TOKEN = r"[\p{L}\p{N}]+"


def decode_utf8(content: Column) -> Column:
    """Bytes to text, dropping malformed sequences and keeping genuine U+FFFD characters."""
    text = content.cast("string")
    guarded = F.replace(text, F.lit(REPLACEMENT), F.lit(PLACEHOLDER))
    repaired = F.replace(F.make_valid_utf8(guarded), F.lit(REPLACEMENT), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(repaired, F.lit(PLACEHOLDER), F.lit(REPLACEMENT))
    )


def is_blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"(?U)\S"))


def windows(text: Column, size: int, overlap: int) -> Column:
    """Array of character windows of ``size`` starting every ``size - overlap`` characters.

    One regex pass cuts the text into step-long segments and each window is glued from
    neighbouring segments, so a long text costs time linear in its length (repeated
    ``substring`` calls would rescan the text from its first character every time).
    """
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    span = -(-size // step)
    segments = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return F.transform(
        segments,
        lambda _, i: F.substring(F.array_join(F.slice(segments, i + 1, F.lit(span)), ""), 1, size),
    )


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
