"""Scans: exported JSON trees, Markdown pages, image folders, flashcard CSV and TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.contracts import is_entry

MAX_BYTES = 100 * 1024 * 1024
# They must equal the reference's for right results. Other types are text.
TYPES = {"SectionHeader": "section_header", "Text": "text", "Caption": "figure_caption", "FigureCaption": "figure_caption", "PageHeader": "page_header", "Equation": "inline_math", "Formula": "inline_math", "TextInlineMath": "inline_math"}


def json_documents(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """path, doc (VARIANT) of each file; a file beyond the limit or not JSON raises."""
    files = spark.read.format("binaryFile").load(path)
    body = F.when(F.col("length") > max_bytes, F.raise_error(F.concat(F.lit("file too large: "), F.col("path"))).cast("string")).otherwise(F.decode("content", "utf-8"))
    return files.select("path", F.parse_json(body).alias("doc"))


def blocks(documents: DataFrame) -> DataFrame:
    """path, page, ord (array), id, source_type, html, bbox, hierarchy: all blocks of Page children, parents
    before children. page is the index among all children of the document. A document without block_type or
    children, a page without bbox or a block without id, block_type or html raises."""
    spark = documents.sparkSession
    for name in ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit"):
        if spark.conf.get(name, None) is None:  # the file's size bounds the recursion
            spark.conf.set(name, "-1")
    return spark.sql("""
        WITH RECURSIVE tree(path, page, ord, node) AS (
          SELECT path, c.pos, array(c.pos), c.value FROM
            (SELECT path, CASE WHEN variant_get(doc, '$.block_type', 'string') IS NULL OR variant_get(doc, '$.children', 'variant') IS NULL
                          THEN raise_error(concat('no block_type or children in ', path)) ELSE doc END AS doc FROM {documents}) d, LATERAL variant_explode(variant_get(doc, '$.children', 'variant')) c
          WHERE variant_get(c.value, '$.block_type', 'string') = 'Page' AND CASE WHEN variant_get(c.value, '$.bbox', 'variant') IS NULL THEN raise_error(concat('a page without bbox in ', path)) ELSE true END
          UNION ALL
          SELECT path, page, concat(ord, array(c.pos)), c.value FROM tree, LATERAL variant_explode(variant_get(node, '$.children', 'variant')) c),
        nodes AS (SELECT path, page, ord, variant_get(node, '$.id', 'string') AS id, variant_get(node, '$.block_type', 'string') AS source_type,
               variant_get(node, '$.html', 'string') AS html, try_variant_get(node, '$.bbox', 'array<double>') AS bbox, try_variant_get(node, '$.section_hierarchy', 'map<string,string>') AS hierarchy
        FROM tree)
        SELECT * FROM nodes WHERE coalesce(source_type, '') NOT IN ('Page', 'Document')
          AND CASE WHEN id IS NULL OR source_type IS NULL OR html IS NULL THEN raise_error(concat('a block without id, block_type or html in ', path)) ELSE true END""", documents=documents)


def content_blocks(rows: DataFrame) -> DataFrame:
    """blocks() with type, level, text, box (zeros if it has fewer than four numbers), cited figures, hierarchy
    ids by numeric level, and section."""
    kinds = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    ids = F.transform(F.array_sort(F.transform(F.map_entries("hierarchy"), lambda e: F.struct(e["key"].cast("int").alias("k"), e["value"].alias("v")))), lambda e: e["v"])
    out = rows.withColumns({"block_type": F.coalesce(F.try_element_at(kinds, F.col("source_type")), F.lit("text")), "level": T.heading_level(F.coalesce("html", F.lit(""))), "content": T.strip_html(F.col("html")), "parent_hierarchy": F.coalesce(ids, F.array().cast("array<string>"))})
    box = F.struct(*[F.coalesce(F.when(F.size("bbox") >= 4, F.col("bbox")[i]), F.lit(0.0)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])
    out = out.withColumns({"bbox": box, "figure_references": T.parsed_references(F.col("content"))})
    return out.withColumn("section_id", F.coalesce(F.try_element_at("parent_hierarchy", F.lit(-1)), F.lit("")))


def markdown_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, page_number, content: text between lines {N}----; what comes before the first is dropped."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    marked = F.regexp_replace("value", r"(?m)^\{(\d+)\}-{2,}[^\n]*", "$1")
    parts = whole.select("path", F.posexplode(F.split(marked, "", -1)).alias("pos", "part")).filter("pos > 0")
    return parts.select("path", F.substring_index("part", "", 1).cast("int").alias("page_number"), T.js_trim(F.substring_index("part", "", -1)).alias("content"))


def markdown_lines(spark: SparkSession, path: str) -> int:
    """How many lines the file has; a line break at its end begins another one."""
    n = spark.read.text(path, wholetext=True).agg(F.sum(F.regexp_count("value", F.lit("\n")) + 1)).first()[0]  # one number
    return n or 0


def images(spark: SparkSession, folder: str) -> DataFrame:
    """image_file, position (from 1) by the first integer in the name, then by name. The folder is
    listed through its Hadoop file system, as Spark's scans skip names that begin with _ or a dot; names
    beginning with a dot are left out here too. A missing folder has no images."""
    from pyspark.sql import Window

    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.{{jpg,jpeg,png,gif}}")
    found = pattern.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = sorted(name for f in found if f.isFile() and not (name := f.getPath().getName()).startswith("."))
    files = spark.createDataFrame([(n,) for n in names], "image_file string")
    number = F.coalesce(F.nullif(F.regexp_extract("image_file", r"(\d+)", 1), F.lit("")).cast("long"), F.lit(0))
    return files.withColumn("position", F.row_number().over(Window.orderBy(number, "image_file")))


FIGURE = "struct<figure_id:string,page_number:int,caption:string,caption_block_id:string,abbreviations:map<string,string>,status:string,image_file:string,image_path:string,referencing_blocks:array<string>>"


def figure_map(spark: SparkSession, path: str) -> DataFrame:
    """document_id (null in the flat form) and the figures of saved maps, {document_id, figures, summary} or
    flat; of equal caption blocks in a file the last one stays. A file that is neither form raises."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    nested = F.from_json("value", f"struct<document_id:string,figures:map<string,{FIGURE}>,summary:struct<total_figures:int>>")
    is_nested = F.get_json_object("value", "$.figures").isNotNull() & F.get_json_object("value", "$.summary").isNotNull()
    entries = F.when(is_nested, nested["figures"]).otherwise(F.from_json("value", f"map<string,{FIGURE}>"))
    whole = F.forall(F.map_values("entries"), is_entry)
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("entries")).otherwise(F.raise_error(F.concat(F.lit("not a figure map: "), F.col("path"))))
    rows = files.select("path", F.when(is_nested, nested["document_id"]).alias("document_id"), entries.alias("entries")).select("path", "document_id", F.posexplode(F.map_values(checked)).alias("pos", "entry"))
    last = rows.groupBy("path", "document_id", "entry.caption_block_id").agg(F.max_by("entry", "pos").alias("entry"))
    return last.select("document_id", "entry.*")


DOCUMENT = "struct<id:string,pages:array<struct<page_number:int,blocks:array<struct<id:string,block_type:string,level:int,content:string,raw_html:string,parent_hierarchy:array<string>,figure_references:array<string>,bbox:struct<x1:double,y1:double,x2:double,y2:double>,section_id:string>>>>>"


def document_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of written documents: document_id, page, block and the block's fields. A file without an id raises."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", DOCUMENT).alias("d"))
    document_id = F.coalesce(F.col("d.id"), F.raise_error(F.concat(F.lit("not a document: "), F.col("path"))).cast("string"))
    pages = files.select(document_id.alias("document_id"), F.explode("d.pages").alias("p"))
    rows = pages.select("document_id", F.col("p.page_number").alias("page"), F.posexplode("p.blocks").alias("block", "b"))
    return rows.select("document_id", "page", "block", "b.*").withColumns({"parent_hierarchy": F.coalesce("parent_hierarchy", F.array().cast("array<string>")), "section_id": F.coalesce("section_id", F.lit(""))})

