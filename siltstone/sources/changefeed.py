"""Change-feed pages landed as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = (
    "value array<struct<id string, name string, lastModifiedDateTime string, "
    "parentReference struct<path string>, file struct<mimeType string>, folder struct<childCount bigint>>>, "
    "`@odata.nextLink` string, `@odata.deltaLink` string"
)


def changed_files(pages: DataFrame) -> DataFrame:
    """Items that are files, of all pages (``pages``: page_no, body)."""
    items = pages.select("page_no", F.posexplode(F.from_json("body", PAGE)["value"]).alias("position", "item"))
    return items.where("item.file is not null").select(
        "page_no",
        "position",
        F.col("item.id").alias("document_id"),
        F.concat_ws("/", "item.parentReference.path", "item.name").alias("source_path"),
        F.col("item.name").alias("filename"),
        F.col("item.lastModifiedDateTime").alias("updated_at"),
    )


def delta_link(pages: DataFrame, previous: str = "") -> DataFrame:
    """One row: the link the last page ends with, or the previous one."""
    link = F.from_json("body", PAGE)["@odata.deltaLink"]
    return pages.agg(F.coalesce(F.max_by(link, "page_no"), F.lit(previous)).alias("delta_link"))
