"""Contracts of rows: for each kind of row, a rule for each of its fields.

A rule is a Column that holds where the field is right; a null field breaks a rule unless the rule allows it.
violations() names the fields that a row breaks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the reference's for right results.
BLOCK_TYPES = ("section_header", "text", "figure_caption", "page_header", "inline_math")
STATUSES = ("mapped", "no-image-in-caption", "unresolved")
BLOCK_ID = r"^/page/\d+/\w+/\d+$"
FIGURE_ID = r"^Fig\. \d+\.\d+$"
CHUNK_ID = r"^[a-z0-9-]+-chunk-[0-9]{4}$"
DOCUMENT_ID = r"^[a-z][a-z0-9-]*$"
CONTEXT = r"^\[Context: .+\]$"
TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"
MOST_TOKENS, MOST_SNIPPET = 600, 150


def _text(name: str) -> Column:
    return F.col(name).isNotNull()


def _some(name: str) -> Column:
    return F.length(name) > 0


def _least(name: str, least: float = 0) -> Column:
    return F.col(name) >= least


def _like(name: str, pattern: str) -> Column:
    return F.col(name).rlike(pattern)


def _box(name: str) -> Column:
    return F.least(*[F.coalesce(F.col(name)[c], F.lit(-1.0)) for c in ("x1", "y1", "x2", "y2")]) >= 0


def BLOCK() -> dict[str, Column]:
    return {
        "id": _like("id", BLOCK_ID), "block_type": F.col("block_type").isin(*BLOCK_TYPES), "level": F.col("level").between(0, 6), "content": _text("content"), "raw_html": _text("raw_html"),
        "parent_hierarchy": _text("parent_hierarchy"), "figure_references": _text("figure_references"), "bbox": _box("bbox"), "section_id": _text("section_id"),
    }


def PAGE() -> dict[str, Column]:
    return {"page_number": _least("page_number"), "blocks": _text("blocks")}


def FIGURE() -> dict[str, Column]:
    return {
        "figure_id": _like("figure_id", FIGURE_ID), "page_number": _least("page_number"), "caption": _some("caption"), "abbreviations": _text("abbreviations"), "status": F.col("status").isin(*STATUSES),
        "image_file": (F.col("status") != "mapped") | (F.length(F.coalesce("image_file", F.lit(""))) > 0),
    }


def SUMMARY() -> dict[str, Column]:
    return {"total_figures": _least("total_figures"), "mapped_count": _least("mapped_count"), "unmapped_count": _least("unmapped_count"), "coverage_percentage": F.col("coverage_percentage").between(0, 100)}


def METADATA() -> dict[str, Column]:
    counts = {c: _least(c) for c in ("source_json_lines", "source_markdown_lines", "total_images", "ligature_count")}
    return {"processed_at": _like("processed_at", TIME), "pipeline_version": _text("pipeline_version"), **counts, "parse_rate": F.col("parse_rate").between(0, 100), "figure_coverage": F.col("figure_coverage").between(0, 100)}


def DOCUMENT() -> dict[str, Column]:
    files = F.col("source_files")
    return {
        "id": _like("id", DOCUMENT_ID), "title": _some("title"), "author": _some("author"), "source_files": files["json"].isNotNull() & files["markdown"].isNotNull() & files["image_dir"].isNotNull(),
        "pages": F.size("pages") > 0, "metadata": _text("metadata"),
    }


def GATE() -> dict[str, Column]:
    return {"name": _text("name"), "threshold": _text("threshold"), "actual": _text("actual"), "status": F.col("status").isin("pass", "fail")}


def REPORT() -> dict[str, Column]:
    return {"document_id": _text("document_id"), "overall_status": F.col("overall_status").isin("pass", "fail"), "failures": F.col("failures").isNull() | F.forall("failures", lambda f: f["gate"].isNotNull() & f["reason"].isNotNull())}


def CHUNK() -> dict[str, Column]:
    ref = lambda r: r["figure_id"].rlike(FIGURE_ID) & (r["image_path"] != "") & (F.length(r["caption_snippet"]) <= MOST_SNIPPET)
    flags = {c: _text(c) for c in ("is_figure_caption", "is_table", "contains_abbreviations")}
    return {
        "chunk_id": _like("chunk_id", CHUNK_ID), "document_id": F.length(F.col("document_id").cast("string")) > 0, "breadcrumb": F.size("breadcrumb") > 0, "breadcrumb_text": _like("breadcrumb_text", CONTEXT),
        "content": _some("content"), "content_with_context": _some("content_with_context"), "page_numbers": (F.size("page_numbers") > 0) & F.forall("page_numbers", lambda p: p >= 1), "source_block_ids": F.size("source_block_ids") > 0,
        "sequence_number": _least("sequence_number"), "parent_section_id": _text("parent_section_id"), "figure_references": F.forall("figure_references", ref), "token_count": F.col("token_count").between(1, MOST_TOKENS),
        "character_count": _least("character_count", 1), "overlap_tokens": _least("overlap_tokens"), **flags,
    }


def INDEX() -> dict[str, Column]:
    return {"document_id": _some("document_id"), "total_chunks": _least("total_chunks"), **{c: _text(c) for c in ("chunks_by_section", "chunks_by_page", "figure_to_chunks")}}


def OUTPUT() -> dict[str, Column]:
    return {"document_id": _some("document_id"), "generated_at": _like("generated_at", TIME), "total_chunks": _least("total_chunks"), "chunks": _text("chunks")}


def is_entry(e: Column) -> Column:
    """Whether a struct is an entry of a figure map: it has an id, a caption block and a known status."""
    return F.coalesce(e["figure_id"].isNotNull() & e["caption_block_id"].isNotNull() & e["status"].isin(*STATUSES), F.lit(False))


def broken(rules: dict[str, Column]) -> Column:
    """The names of the rules that don't hold, in order."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda v: v.isNotNull())


def violations(rows: DataFrame, rules: Callable[[], dict[str, Column]]) -> DataFrame:
    """Adds violations, the fields that a row breaks. A field whose column is missing is broken in every row."""
    every = {name: (ok if name in rows.columns else F.lit(False)) for name, ok in rules().items()}
    return rows.withColumn("violations", broken(every))


def require(rows: DataFrame, rules: Callable[[], dict[str, Column]], what: str) -> DataFrame:
    """rows; one that breaks its contract raises as it is read."""
    bad = broken({name: (ok if name in rows.columns else F.lit(False)) for name, ok in rules().items()})
    checked = F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit(f"{what} breaks its contract: "), F.array_join(bad, ", "))).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(checked)
