"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import work_path


def whole_text(df: DataFrame, text: str) -> Column:
    """The text column, NULL as empty."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def id_and_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Two columns ``doc_id`` and ``text``, whatever else the table holds or calls its columns."""
    return df.select(df[key].alias("doc_id"), whole_text(df, text).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends there, and any executor may be lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_ids(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows whose id is not in the one column of ``gone``; NULL ids compare equal. Columns stay as they are."""
    named = gone.select(gone[gone.columns[0]].alias("_gone_id"))
    return docs.join(named, docs[key].eqNullSafe(named["_gone_id"]), "left_anti")
