"""The chunk program: ingested blocks and their figure map to chunks, an index, gates and a preview.

    python -m leafmill.plans.chunk --in DIR --out DIR [--force] [--lenient] [--verbose]
    python -m leafmill.plans.chunk --document FILE --figure-map FILE --out DIR [--force] [--lenient] [--verbose]

--in is a folder written by the ingest program. Each output is a folder below --out: chunks (Parquet),
chunks_json, chunk_index and validation (JSON), preview (one HTML page).
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..log import Logger
from ..operators import chunks as K
from ..operators import figures as G
from ..sources import readers, sinks
from .ingest import existing

OUTPUTS = ("chunks", "chunks_json", "chunk_index", "validation", "preview")
MOST_SECONDS = 30


def chunks(blocks: DataFrame, figures: DataFrame) -> DataFrame:
    """Split, attach figures, overlap, merge, link: the columns of CHUNK."""
    split = K.split_blocks(K.breadcrumbs(blocks.drop("figure_references")))
    rows = split.withColumns({
        "breadcrumb": F.when(F.size("breadcrumb") > 0, F.col("breadcrumb")).otherwise(F.array(F.lit("Document Root"))), "is_figure_caption": F.col("block_type") == "figure_caption",
        "page_numbers": F.array(F.col("page") + 1), "source_block_ids": F.array("id"),
    })
    whole = K.link(K.merge_small(K.overlap(G.attach(rows, figures))))
    return whole.withColumnRenamed("section_id", "parent_section_id").withColumns({"is_table": F.lit(False), "contains_abbreviations": F.lit(False)}).select(*K.CHUNK)


def chunks_json(rows: DataFrame) -> DataFrame:
    """document_id, json: all chunks of a document in order."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("sequence_number", F.struct(*rows.columns).alias("c")))), lambda e: e["c"])
    got = rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("total_chunks"), ordered.alias("chunks"))
    return got.select("document_id", F.to_json(F.struct("document_id", now.alias("generated_at"), "total_chunks", "chunks"), {"ignoreNullFields": "false"}).alias("json"))


def chunk_index(rows: DataFrame) -> DataFrame:
    """document_id, json: chunk ids by section, by page and by figure."""
    sides = {"chunks_by_section": "parent_section_id", "chunks_by_page": "page_numbers", "figure_to_chunks": "figures"}
    flat = rows.select("document_id", "chunk_id", "sequence_number", "parent_section_id", F.col("page_numbers").cast("array<string>").alias("page_numbers"), F.transform("figure_references", lambda r: r["figure_id"]).alias("figures"))
    out = rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("total_chunks"))
    for name, key in sides.items():
        by = K.index_by(flat, key).groupBy("document_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "chunk_ids")))).alias(name))
        out = out.join(by, "document_id", "left").withColumn(name, F.coalesce(name, F.create_map().cast("map<string,array<string>>")))
    return out.select("document_id", F.to_json(F.struct("document_id", "total_chunks", *sides)).alias("json"))


def validation(rows: DataFrame, blocks: DataFrame, seconds: float) -> DataFrame:
    """One row: timestamp, overall_status, gates, summary."""
    ordered = rows.select("*", F.col("parent_section_id").alias("section_id"), F.lit(0).alias("page"), F.col("sequence_number").alias("block"), F.lit(0).alias("part"))
    spark = rows.sparkSession
    clock = spark.createDataFrame([("processing_time", seconds, seconds < MOST_SECONDS, f"{seconds:.2f}s", f"<{MOST_SECONDS}s", None)], "gate string, value double, passed boolean, shown string, threshold string, details string")
    all_ = K.gates(ordered, blocks).unionAll(clock)
    gate = F.struct(F.col("gate").alias("name"), F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"), F.col("shown").alias("value"), "threshold", "details")
    gates = all_.agg(F.when(F.bool_and("passed"), "PASS").otherwise("FAIL").alias("overall_status"), F.collect_list(gate).alias("gates"))
    s = K.summary(rows)
    summary = s.select(F.struct("total_chunks", F.col("figure_captions").alias("figure_caption_chunks"), F.col("max_tokens").alias("max_token_count"), F.col("avg_tokens").alias("avg_token_count"), F.col("with_overlap").alias("chunks_with_overlap")).alias("summary"))
    return gates.join(F.broadcast(summary), F.lit(True)).select(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), "overall_status", "gates", "summary")


def run(spark: SparkSession, blocks: DataFrame, figures: DataFrame, out: str, force: bool = False, strict: bool = True) -> DataFrame:
    """Writes all outputs and returns the validation. Refuses before the first write if one is there, unless
    forced. Strict: if chunks break their contract, nothing stays written and ValueError names some. A figure map
    without a document is that of the one document there is."""
    began = time.time()
    if not force and (there := existing(spark, out, OUTPUTS)):
        raise FileExistsError(f"already written: {', '.join(there)}")
    ids = [r.document_id for r in blocks.select("document_id").distinct().limit(2).collect()]  # two at most
    if len(ids) > 1 and figures.filter("document_id IS NULL").take(1):
        raise ValueError("a figure map without a document, and several documents")
    known = figures.withColumn("document_id", F.coalesce("document_id", F.lit(ids[0] if ids else None)))
    sinks.write(chunks(blocks, known), f"{out}/chunks", force, "parquet")
    rows = spark.read.parquet(f"{out}/chunks")
    broken = K.violations(rows).filter("size(violations) > 0").select("chunk_id", "violations").limit(5).collect() if strict else []
    if broken:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/chunks")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        raise ValueError("chunks break their contract: " + "; ".join(f"{r.chunk_id} ({', '.join(r.violations)})" for r in broken))
    sinks.write(chunks_json(rows).select("json"), f"{out}/chunks_json", force, "text")
    sinks.write(chunk_index(rows).select("json"), f"{out}/chunk_index", force, "text")
    sinks.write(validation(rows, blocks, time.time() - began), f"{out}/validation", force)
    sinks.write(sinks.preview_page(rows), f"{out}/preview", force, "text")
    return spark.read.json(f"{out}/validation")


def main(args: list[str]) -> int:
    """0 if all gates pass."""
    parser = argparse.ArgumentParser(prog="chunk")
    for name in ("--in", "--document", "--figure-map"):
        parser.add_argument(name)
    parser.add_argument("--out", required=True)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--lenient", action="store_true")
    parser.add_argument("--verbose", action="store_true")
    given = vars(parser.parse_args(args))
    folder = given["in"]
    if not folder and not (given["document"] and given["figure_map"]):
        parser.error("--in, or --document and --figure-map, are needed")
    spark = SparkSession.builder.appName("leafmill-chunk").getOrCreate()
    blocks = spark.read.parquet(f"{folder}/blocks") if folder else readers.document_blocks(spark, given["document"])
    figures = readers.figure_map(spark, f"{folder}/figure_map" if folder else given["figure_map"])
    log = Logger("chunk", "debug" if given["verbose"] else None)
    log.debug("reading", **{k: given[k] for k in ("in", "document", "figure_map")})
    got = run(spark, blocks, figures, given["out"], given["force"], not given["lenient"]).first()
    log.debug("written", out=given["out"], chunks=got.summary.total_chunks)
    for g in got.gates:
        print(f"{g.status} {g.name}: {g.value} (threshold {g.threshold}) {g.details or ''}".rstrip())
    print(f"{got.overall_status}: {got.summary.total_chunks} chunks")
    return int(got.overall_status != "PASS")


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
