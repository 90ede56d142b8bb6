"""Sinks: nested JSON, Markdown, chunk outputs, import TSV, batched pushes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BLOCK = ("id", "block_type", "level", "content", "raw_html", "parent_hierarchy", "figure_references", "bbox", "section_id")


def document_json(blocks: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """document_id, json: pages (page_number, blocks) in order, with the fields of details (document_id, title, author,
    source_files, figure_map, metadata) around them; readers.document_blocks reads it again."""
    block = F.struct("block", F.struct(*[c for c in BLOCK if c in blocks.columns]).alias("b"))
    in_order = lambda x: F.transform(F.sort_array(F.collect_list(x)), lambda e: e["b"])
    pages = blocks.groupBy("document_id", "page").agg(in_order(block).alias("blocks"))
    page = F.struct("page", F.struct(F.col("page").alias("page_number"), "blocks").alias("b"))
    whole = pages.groupBy("document_id").agg(in_order(page).alias("pages"))
    around = [[], []]
    if details is not None:
        whole = whole.join(details, "document_id", "left")
        around = [["title", "author", "source_files"], ["figure_map", "metadata"]]
    return whole.select("document_id", F.to_json(F.struct(F.col("document_id").alias("id"), *around[0], "pages", *around[1])).alias("json"))


def figures_by_id(figures: DataFrame) -> Column:
    """The aggregate of a document's figures as a map, by id. Entries hold maps, so they are sorted by id alone."""
    entry = F.struct("figure_id", F.struct(*[c for c in figures.columns if c != "document_id"]).alias("entry"))
    order = lambda a, b: F.when(a["figure_id"] < b["figure_id"], -1).when(a["figure_id"] > b["figure_id"], 1).otherwise(0)
    return F.map_from_entries(F.array_sort(F.collect_list(entry), order))


def figure_map_json(figures: DataFrame) -> DataFrame:
    """document_id, json: the figures by id and their summary; readers.figure_map reads it again."""
    from ..operators.figures import summary_of

    summary = F.struct(*[c.alias(name) for name, c in summary_of().items()])
    got = figures.groupBy("document_id").agg(figures_by_id(figures).alias("figures"), summary.alias("summary"))
    return got.select("document_id", F.to_json(F.struct("document_id", "figures", "summary")).alias("json"))


def markdown(blocks: DataFrame, title: str, author: str) -> DataFrame:
    """document_id, markdown: title, author and a rule; headings by level, page headers left out, blank lines between."""
    line = F.when((F.col("block_type") == "section_header") & F.col("level").between(1, 6), F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "content")).otherwise(F.col("content"))
    rows = blocks.filter("block_type <> 'page_header' AND content <> ''").select("document_id", F.struct("page", "block", line.alias("line")).alias("x"))
    head = F.lit(f"# {title}\n\n**Author:** {author}\n\n---\n\n")
    return rows.groupBy("document_id").agg(F.concat(head, F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"]), "\n\n"), F.lit("\n")).alias("markdown"))


def write(df: DataFrame, path: str, force: bool = False, kind: str = "json") -> None:
    """Refuses to replace what is there unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").format(kind).save(path)


def escaped(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def preview(chunks: DataFrame) -> DataFrame:
    """Adds html, a card for each chunk; what the card shows of optional columns is there if they are."""
    col, lit = F.col, F.lit
    has = set(chunks.columns)
    span = lambda kind, x: F.concat(lit(f'<span class="{kind}">'), x, lit("</span>"))
    kinds = [F.when(col(c), span("tag", lit(label))) for c, label in (("is_figure_caption", "CAPTION"), ("is_table", "TABLE")) if c in has]
    tags = F.concat_ws(" ", *kinds, F.when(col("overlap_tokens") > 0, span("tag", F.format_string("+%d overlap", "overlap_tokens"))))
    counts = [F.format_string(f"{label} %d", name) for label, name in (("Tokens:", "token_count"), ("Chars:", "character_count")) if name in has]
    pages = [F.concat(lit("Pages: "), F.array_join(col("page_numbers").cast("array<string>"), ", "))] if "page_numbers" in has else []
    refs = F.when(F.size("figure_references") > 0, F.concat(lit("<p>References: "), F.array_join(F.transform("figure_references", lambda r: r["figure_id"]), ", "), lit("</p>"))) if "figure_references" in has else lit(None).cast("string")
    links = [F.when(col(c).isNotNull(), F.concat(lit('<a href="#'), c, lit(f'">{label}</a>'))) for c, label in (("previous_chunk_id", "Prev"), ("next_chunk_id", "Next")) if c in has]
    card = F.concat_ws(
        "", F.concat(lit('<div class="chunk" id="'), "chunk_id", lit('" data-caption="'), col("is_figure_caption").cast("string"), lit('" data-table="'), (col("is_table") if "is_table" in has else lit(False)).cast("string"), lit('" data-overlap="'), col("overlap_tokens").cast("string"), lit('"><h3>')), escaped(col("chunk_id")), lit("</h3><p>"),
        tags, lit(" "), F.concat_ws(" | ", *pages, *counts), lit("</p><p>"), escaped(col("breadcrumb_text")), lit("</p><pre>"), escaped(col("content")), lit("</pre>"), refs, F.concat_ws(" ", *links), lit("</div>"),
    )
    return chunks.withColumn("html", card)


PAGE_HEAD = """<!doctype html><meta charset="utf-8"><title>Chunks</title>
<style>.chunk{border:1px solid #ccc;margin:1em;padding:1em}.tag{background:#ddd;padding:0 .4em}pre{white-space:pre-wrap}[hidden]{display:none}</style>
<input id="text" placeholder="Search"><select id="kind"><option value="">all</option><option value="caption">captions</option><option value="table">tables</option><option value="overlap">with overlap</option></select>"""
PAGE_FOOT = """<script>
const text = document.getElementById("text"), kind = document.getElementById("kind");
text.oninput = kind.onchange = () => document.querySelectorAll(".chunk").forEach(c => {
  const apt = {"": true, caption: c.dataset.caption === "true", table: c.dataset.table === "true", overlap: Number(c.dataset.overlap) > 0}[kind.value];
  c.hidden = !apt || !c.textContent.toLowerCase().includes(text.value.toLowerCase());
});
</script>"""


def preview_page(chunks: DataFrame) -> DataFrame:
    """value: the lines of one page with the cards of all chunks, in order, and a filter of text and kind."""
    spark = chunks.sparkSession
    edges = spark.createDataFrame([(0, "", 0, PAGE_HEAD), (2, "", 0, PAGE_FOOT)], "at int, document_id string, sequence_number int, value string")
    cards = preview(chunks).select(F.lit(1).alias("at"), F.col("document_id").cast("string").alias("document_id"), F.col("sequence_number").cast("int").alias("sequence_number"), F.col("html").alias("value"))
    return edges.unionAll(cards).orderBy("at", "document_id", "sequence_number").select("value")


def push(rows: DataFrame, client: Callable[[list[dict]], list], batch: int = 50) -> DataFrame:
    """Sends rows in batches through client; a null answer is a duplicate. Returns added, duplicates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            records = pdf.to_dict("records")
            for i in range(0, len(records), batch):
                got = client(records[i : i + batch])
                yield pd.DataFrame({"added": [sum(x is not None for x in got)], "duplicates": [sum(x is None for x in got)]})

    return rows.mapInPandas(run, "added long, duplicates long").agg(F.coalesce(F.sum("added"), F.lit(0)).alias("added"), F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"))
