"""Figure map: captions matched to images by position, and the blocks that cite them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def figure_map(blocks: DataFrame, images: DataFrame) -> DataFrame:
    """blocks: document_id, page, block, id, block_type, content, and raw_html if there. images: document_id, position
    (from 1), image_file. A caption with an inline image keeps it; the n-th other caption, by
    chapter and then document order, takes the n-th image. Of equal ids the last caption stays. Abbreviations
    are those of the caption's HTML, or of its text without one."""
    source = F.coalesce(F.nullif(F.col("raw_html"), F.lit("")), F.col("content")) if "raw_html" in blocks.columns else F.col("content")
    captions = blocks.filter("block_type = 'figure_caption'").select("document_id", "page", "block", F.col("id").alias("caption_block_id"), T.figure_id(F.col("content")).alias("figure_id"), T.inline_image(F.col("content")).alias("inline"), T.caption_text(F.col("content")).alias("caption"), T.caption_abbreviations(source).alias("abbreviations")).filter("figure_id IS NOT NULL")
    chapter = F.regexp_extract("figure_id", r"(\d+)\.", 1).cast("int")
    order = Window.partitionBy("document_id").orderBy("chapter", "page", "block")
    ranked = captions.withColumn("chapter", chapter).withColumns({"n": F.row_number().over(order), "rank": F.sum(F.col("inline").isNull().cast("int")).over(order)})
    met = ranked.join(images.select(F.col("document_id").alias("i_doc"), "position", "image_file"), (F.col("document_id") == F.col("i_doc")) & (F.col("rank") == F.col("position")) & F.col("inline").isNull(), "left")
    image = F.coalesce("inline", "image_file")
    last = Window.partitionBy("document_id", "figure_id").orderBy(F.col("n").desc())
    out = met.select("document_id", "figure_id", F.col("page").alias("page_number"), "caption", "caption_block_id", "abbreviations", F.when(image.isNull(), "no-image-in-caption").otherwise("mapped").alias("status"), image.alias("image_file"), F.row_number().over(last).alias("k"))
    return out.filter("k = 1").drop("k")


def entries(blocks: DataFrame, images: DataFrame, folder: str) -> DataFrame:
    """The figure map with image_path, below the folder, and referencing_blocks."""
    figures = figure_map(blocks, images)
    cited = references(blocks, figures)
    out = figures.withColumn("image_path", F.concat(F.lit(f"{folder}/"), "image_file")).join(cited, ["document_id", "figure_id"], "left")
    return out.withColumn("referencing_blocks", F.coalesce("referencing_blocks", F.array().cast("array<string>")))


def by_id(figures: DataFrame, ids: DataFrame) -> DataFrame:
    """The figures with those ids (document_id, figure_id)."""
    return figures.join(ids.select("document_id", "figure_id").distinct(), ["document_id", "figure_id"], "left_semi")


def by_caption_block(figures: DataFrame, ids: DataFrame) -> DataFrame:
    """The figures whose captions stand in those blocks (document_id, caption_block_id)."""
    return figures.join(ids.select("document_id", "caption_block_id").distinct(), ["document_id", "caption_block_id"], "left_semi")


def references(blocks: DataFrame, figures: DataFrame) -> DataFrame:
    """document_id, figure_id, referencing_blocks in document order."""
    cited = blocks.select("document_id", "page", "block", "id", F.explode(T.figure_references(F.col("content"))).alias("figure_id"))
    return cited.join(figures.select("document_id", "figure_id"), ["document_id", "figure_id"]).groupBy("document_id", "figure_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("page", "block", "id"))), lambda x: x["id"]).alias("referencing_blocks"))


def attach(chunks: DataFrame, figures: DataFrame, key: tuple[str, ...] = ("document_id", "page", "block", "part")) -> DataFrame:
    """chunks (id, content, is_figure_caption and the key) with figure_references: structs of figure_id,
    image_path and caption_snippet. A caption takes the figure of its block; other text takes the figures
    that it cites as 'Fig. X.Y', in the order of their first mention. Labels without a figure are left out."""
    image = F.coalesce(*[F.col(c) for c in ("image_path", "image_file") if c in figures.columns], F.lit(""))
    refs = figures.select("document_id", "figure_id", "caption_block_id", F.struct("figure_id", image.alias("image_path"), T.snippet(F.col("caption")).alias("caption_snippet")).alias("ref"))
    labels = F.transform(F.regexp_extract_all("content", F.lit(r"(?i)Fig\.\s*(\d+\.\d+)"), F.lit(1)), lambda n: F.concat(F.lit("Fig. "), n))
    cited = chunks.filter(~F.col("is_figure_caption")).select(*key, F.posexplode(F.array_distinct(labels)).alias("pos", "figure_id"))
    own = chunks.filter("is_figure_caption").select(*key, F.lit(0).alias("pos"), F.col("id").alias("caption_block_id"))
    found = [side.join(refs, ["document_id", on]).select(*key, "pos", "ref") for side, on in ((cited, "figure_id"), (own, "caption_block_id"))]
    lists = found[0].unionAll(found[1]).groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "ref"))), lambda x: x["ref"]).alias("figure_references"))
    empty = F.array().cast("array<struct<figure_id:string,image_path:string,caption_snippet:string>>")
    return chunks.join(lists, list(key), "left").withColumn("figure_references", F.coalesce("figure_references", empty))


STATUSES = ("mapped", "no-image-in-caption", "unresolved")


def summary_of() -> dict:
    """The aggregates that summarise figures; without figures the coverage is 0."""
    mapped, total = F.count_if(F.col("status") == "mapped"), F.count(F.lit(1))
    return {"total_figures": total, "mapped_count": mapped, "unmapped_count": F.count_if(F.col("status") != "mapped"), "coverage_percentage": F.coalesce(F.try_divide(mapped * 100.0, total), F.lit(0.0)), "by_status": F.struct(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])}


def summary(figures: DataFrame) -> DataFrame:
    """total_figures, mapped_count, unmapped_count, coverage_percentage, by_status."""
    return figures.agg(*[c.alias(name) for name, c in summary_of().items()])
