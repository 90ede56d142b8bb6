"""Documents as wholes: what stands around their pages, and the metadata of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import measure

VERSION = "1.0.0"


def now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def metadata(blocks: DataFrame, figures: DataFrame, images: DataFrame, markdown_lines: Column) -> DataFrame:
    """document_id and metadata, from blocks (document_id, source_id, content), figures (document_id, status), images
    (document_id) and the count of Markdown lines. JSON lines are the blocks of the source."""
    counted = blocks.groupBy("document_id").agg(F.count("source_id").alias("source_json_lines"))
    pictures = images.groupBy("document_id").agg(F.count(F.lit(1)).alias("total_images"))
    whole = counted.join(measure(blocks, figures), "document_id").join(pictures, "document_id", "left")
    fields = {"processed_at": now(), "pipeline_version": F.lit(VERSION), "source_json_lines": F.col("source_json_lines"), "source_markdown_lines": markdown_lines.cast("long"), "total_images": F.coalesce("total_images", F.lit(0)).cast("long")}
    return whole.select("document_id", F.struct(*[c.alias(n) for n, c in fields.items()], "parse_rate", "ligature_count", "figure_coverage").alias("metadata"))


def details(described: DataFrame, entries: DataFrame, meta: DataFrame) -> DataFrame:
    """described (document_id, title, author, source_files) with figure_map, from figure entries, and metadata."""
    from ..sources.sinks import figures_by_id

    maps = entries.groupBy("document_id").agg(figures_by_id(entries).alias("figure_map"))
    return described.join(maps, "document_id", "left").join(meta, "document_id", "left")
