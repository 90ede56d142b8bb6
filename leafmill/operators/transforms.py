"""Small changes of chunk rows, and what arrays need when rows are united."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def with_token_count(chunks: DataFrame, count: Column) -> DataFrame:
    return chunks.withColumn("token_count", count)


def with_figure_ref(chunks: DataFrame, ref: Column) -> DataFrame:
    """Appends one reference."""
    return chunks.withColumn("figure_references", F.concat("figure_references", F.array(ref)))


def with_figure_refs(chunks: DataFrame, refs: Column) -> DataFrame:
    return chunks.withColumn("figure_references", refs)


def with_overlap(chunks: DataFrame, text: Column, tokens: Column) -> DataFrame:
    """Prepends text and a blank, and counts anew."""
    content = F.concat(text, F.lit(" "), "content")
    whole = F.concat("breadcrumb_text", F.lit("\n\n"), content)
    return chunks.withColumns({"content": content, "content_with_context": whole, "overlap_tokens": tokens, "token_count": T.tokens(whole), "character_count": T.utf16_length(content)})


def without_overlap(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("overlap_tokens", F.lit(0))


def with_linking(chunks: DataFrame, chunk_id: Column, number: Column, before: Column, after: Column) -> DataFrame:
    return chunks.withColumns({"chunk_id": chunk_id, "sequence_number": number, "previous_chunk_id": before, "next_chunk_id": after})


def link_next(chunks: DataFrame) -> DataFrame:
    """Each chunk's next_chunk_id, by sequence_number; the last one keeps its own."""
    following = F.lead("chunk_id").over(Window.partitionBy("document_id").orderBy("sequence_number"))
    return chunks.withColumn("next_chunk_id", F.coalesce(following, "next_chunk_id"))


def as_figure_caption(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("is_figure_caption", F.lit(True))


def merge_unique(a: Column, b: Column) -> Column:
    """a, and what of b isn't in it, in order."""
    return F.concat(a, F.array_except(b, a))


def merge_sorted_unique(a: Column, b: Column) -> Column:
    return F.array_sort(merge_unique(a, b))


def dedupe(a: Column) -> Column:
    """The first of equals stays."""
    return F.array_distinct(a)
