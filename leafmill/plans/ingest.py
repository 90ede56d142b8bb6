"""The ingest program: an exported JSON tree, its Markdown and its images to a document, a figure map, Markdown and gates.

    python -m leafmill.plans.ingest --json FILE --images DIR --out DIR --title TEXT [--markdown FILE] [--author TEXT] [--id NAME] [--force]
    python -m leafmill.plans.ingest --config FILE [--force]
    python -m leafmill.plans.ingest --out DIR --validate-only

Each output is a folder below --out, written by Spark: blocks (Parquet), document, figure_map and report
(JSON), content (text).
"""

from __future__ import annotations

import argparse
import re
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..log import Logger
from ..operators import contracts as R
from ..operators import documents as D
from ..operators import figures as G
from ..operators import gates as V
from ..sources import config, readers, sinks

OUTPUTS = ("blocks", "document", "figure_map", "content", "report")


def kebab(title: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", title.lower()).strip("-")


def blocks(spark: SparkSession, json_path: str, document_id: str) -> DataFrame:
    """The document's blocks in order, their text normalised."""
    rows = readers.content_blocks(readers.blocks(readers.json_documents(spark, json_path)))
    in_page = Window.partitionBy("path", "page").orderBy("ord")
    return rows.select(F.lit(document_id).alias("document_id"), "page", (F.row_number().over(in_page) - 1).alias("block"), "id", "block_type", "level", T.normalize(F.col("content")).alias("content"), F.col("html").alias("raw_html"), "parent_hierarchy", "figure_references", "bbox", "section_id")


def report(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """One row per document and gate."""
    return V.evaluate(V.measure(rows.withColumn("source_id", F.col("id")), figures))


def existing(spark: SparkSession, out: str, names: tuple[str, ...]) -> list[str]:
    """Those of the outputs that are there."""
    sc = spark.sparkContext
    paths = [sc._jvm.org.apache.hadoop.fs.Path(f"{out}/{name}") for name in names]
    return [p.toString() for p in paths if p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)]


def normalized(rows: DataFrame) -> DataFrame:
    """blocks, characters and ligatures before and after normalisation, of rows with html and content."""
    plain = T.strip_html(F.col("raw_html"))
    sums = {"blocks": F.count(F.lit(1)), "characters_before": F.sum(F.length(plain)), "characters_after": F.sum(F.length("content")), "ligatures_before": F.sum(T.ligature_count(plain)), "ligatures_after": F.sum(T.ligature_count(F.col("content")))}
    return rows.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in sums.items()])


def ingest(spark: SparkSession, json_path: str, image_dir: str, out: str, title: str, force: bool = False, author: str = "Unknown", markdown: str | None = None, document_id: str | None = None) -> DataFrame:
    """Writes all outputs and returns the report. Refuses before the first write if one is there, unless forced; a
    block, figure or document that breaks its contract raises."""
    if not force and (there := existing(spark, out, OUTPUTS)):
        raise FileExistsError(f"already written: {', '.join(there)}")
    document_id = document_id or kebab(title)
    log = Logger("ingest")
    log.info("reading", json=json_path, markdown=markdown, images=image_dir)
    sinks.write(R.require(blocks(spark, json_path, document_id), R.BLOCK, "a block"), f"{out}/blocks", force, "parquet")
    rows = spark.read.parquet(f"{out}/blocks")
    images = readers.images(spark, image_dir).withColumn("document_id", F.lit(document_id))
    figures = R.require(G.entries(rows, images, image_dir), R.FIGURE, "a figure")
    sinks.write(sinks.figure_map_json(figures).select("json"), f"{out}/figure_map", force, "text")
    files = F.struct(F.lit(json_path).alias("json"), F.lit(markdown or "").alias("markdown"), F.lit(image_dir).alias("image_dir"))
    described = spark.createDataFrame([(document_id, title, author)], "document_id string, title string, author string").withColumn("source_files", files)
    lines = readers.markdown_lines(spark, markdown) if markdown else 0
    meta = D.metadata(rows.withColumn("source_id", F.col("id")), figures, images, F.lit(lines))
    sinks.write(sinks.document_json(rows, D.details(described, figures, meta)).select("json"), f"{out}/document", force, "text")
    sinks.write(sinks.markdown(rows, title, author).select("markdown"), f"{out}/content", force, "text")
    sinks.write(report(rows, figures), f"{out}/report", force)
    log.info("written", out=out, **normalized(rows).first().asDict())  # five numbers
    return spark.read.json(f"{out}/report")


def validate(spark: SparkSession, out: str) -> DataFrame:
    """The report of what an earlier run has written."""
    return report(spark.read.parquet(f"{out}/blocks"), readers.figure_map(spark, f"{out}/figure_map"))


def main(args: list[str]) -> int:
    """0 if all gates pass."""
    parser = argparse.ArgumentParser(prog="ingest")
    for name in ("--json", "--markdown", "--images", "--title", "--author", "--id", "--config", "--out"):
        parser.add_argument(name)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--validate-only", action="store_true")
    given = parser.parse_args(args)
    if given.config:
        c = config.load(given.config)
        own = {**{k: c["sources"][v] for k, v in (("json", "json"), ("markdown", "markdown"), ("images", "imageDir"))}, **c["document"], "out": c["output"]["baseDir"]}
        for name, value in own.items():
            if getattr(given, name) is None:
                setattr(given, name, value)
    if not given.out:
        parser.error("--out is needed")
    if not given.validate_only and not (given.json and given.images and given.title):
        parser.error("--json, --images and --title are needed")
    spark = SparkSession.builder.appName("leafmill-ingest").getOrCreate()
    got = validate(spark, given.out) if given.validate_only else ingest(spark, given.json, given.images, given.out, given.title, given.force, given.author or "Unknown", given.markdown, given.id)
    gates = got.orderBy("document_id", "gate").collect()  # three rows
    for r in gates:
        print(f"{r.status.upper()} {r.name}: {r.actual:g} (threshold {r.threshold}) {r.details}")
    return int(not gates or any(r.status != "pass" for r in gates))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
