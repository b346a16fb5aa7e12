"""Document chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as tx

# Characters per chunk and characters shared by neighbours.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200


def decode(files: DataFrame, content: str = "content", output: str = "text") -> DataFrame:
    return files.withColumn(output, tx.decode_utf8(F.col(content)))


def chunk(docs: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per non-blank character window; the index counts only the windows that are kept."""
    kept = F.filter(tx.windows(F.col(text), size, overlap), lambda piece: ~tx.is_blank(piece))
    others = [c for c in docs.columns if c != text]
    pieces = docs.select(*others, F.posexplode(kept).alias("chunk_index", "chunk_text"))
    return pieces.withColumn("chunk_index", F.col("chunk_index").cast("long"))
