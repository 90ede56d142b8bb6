"""Blocks to linked, overlapping, merged chunks. Blocks and chunks carry document_id and an order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.packing import count, split_block_udf

TARGET, HARD, SMALL = 512, 600, 80
#: What a merge carries along where it is there; CHUNK is the order of a written chunk's columns.
CARRIED = ("breadcrumb", "character_count", "overlap_tokens", "figure_references", "page_numbers", "source_block_ids")
CHUNK = ("chunk_id", "document_id", "breadcrumb", "breadcrumb_text", "content", "content_with_context", "page_numbers", "source_block_ids", "sequence_number", "previous_chunk_id", "next_chunk_id", "parent_section_id", "figure_references", "token_count", "character_count", "overlap_tokens", "is_figure_caption", "is_table", "contains_abbreviations")


def header_index(blocks: DataFrame) -> DataFrame:
    """document_id, id, label of the section headers; the last one of an id wins, empty labels go."""
    heads = blocks.filter("block_type = 'section_header'")
    return heads.groupBy("document_id", "id").agg(F.max_by("content", F.struct("page", "block")).alias("label")).filter("label <> '' AND id IS NOT NULL")


def breadcrumbs(blocks: DataFrame) -> DataFrame:
    """Adds breadcrumb (labels of parent_hierarchy, in order; unresolved ids are skipped) and its text. A document's
    headers meet its blocks as one map, on the partitioning by document that linking needs anyway."""
    maps = header_index(blocks).groupBy(F.col("document_id").alias("__doc")).agg(F.map_from_entries(F.collect_list(F.struct("id", "label"))).alias("__labels"))
    found = F.filter(F.transform("parent_hierarchy", lambda i: F.try_element_at("__labels", i)), lambda label: label.isNotNull())
    out = blocks.join(maps, F.col("document_id") == F.col("__doc"), "left").withColumn("breadcrumb", F.coalesce(found, F.array().cast("array<string>"))).drop("__doc", "__labels")
    return out.withColumn("breadcrumb_text", F.concat(F.lit("[Context: "), F.when(F.size("breadcrumb") > 0, F.array_join("breadcrumb", " > ")).otherwise("Document Root"), F.lit("]")))


def processable() -> Column:
    """page headers are chunked, section headers and blank blocks are not."""
    return (F.col("block_type") != "section_header") & (T.js_trim(F.coalesce("content", F.lit(""))) != "")


def split_blocks(blocks: DataFrame, target: int = TARGET) -> DataFrame:
    """blocks with breadcrumb_text: one row per chunk, in document order by (page, block, part)."""
    prefix = F.concat("breadcrumb_text", F.lit("\n\n"))
    # blocks that fit stay in the JVM
    fits = T.tokens(F.col("content")) <= target - T.tokens(prefix)
    parts = F.when(fits, F.array("content")).otherwise(split_block_udf(target)(F.when(~fits, F.col("content")), F.when(~fits, T.tokens(prefix)).otherwise(0)))
    out = blocks.filter(processable()).select("*", F.posexplode(parts).alias("part", "chunk"))
    return out.withColumns({"content": F.col("chunk"), "content_with_context": F.concat(prefix, "chunk")}).drop("chunk").withColumns({"token_count": T.tokens(F.col("content_with_context")), "character_count": T.utf16_length(F.col("content"))})


def _order() -> Window:
    return Window.partitionBy("document_id").orderBy("page", "block", "part")


def link(chunks: DataFrame) -> DataFrame:
    """sequence_number from 0, chunk_id, previous_chunk_id, next_chunk_id."""
    numbered = chunks.withColumn("sequence_number", F.row_number().over(_order()) - 1)
    named = numbered.withColumn("chunk_id", F.concat(F.col("document_id").cast("string"), F.lit("-chunk-"), F.format_string("%04d", "sequence_number")))
    return named.withColumns({"previous_chunk_id": F.lag("chunk_id").over(_order()), "next_chunk_id": F.lead("chunk_id").over(_order())})


def overlap(chunks: DataFrame, hard: int = HARD) -> DataFrame:
    """Prepends the last two sentences of the previous chunk of the same section, if the result fits."""
    before = chunks.withColumns({"__text": F.lag("content").over(_order()), "__section": F.lag("section_id").over(_order())})
    last = F.array_join(T.last_sentences(F.col("__text"), 2), " ")
    tail = F.concat(last, F.lit(" "))
    apt = (F.col("__section") == F.col("section_id")) & ~F.col("is_figure_caption") & (T.js_trim(tail) != "")
    longer = F.when(apt, F.concat(F.col("breadcrumb_text"), F.lit("\n\n"), tail, F.col("content")))
    tried = before.withColumns({"__tail": tail, "__longer": longer})
    fits = F.coalesce(T.tokens(F.col("__longer")) <= hard, F.lit(False)) & F.col("__longer").isNotNull()
    out = tried.withColumn("overlap_tokens", F.when(fits, T.tokens(last)).otherwise(0)).withColumn("content", F.when(fits, F.concat("__tail", "content")).otherwise(F.col("content"))).withColumn("content_with_context", F.when(fits, F.col("__longer")).otherwise(F.col("content_with_context")))
    return out.withColumns({"token_count": T.tokens(F.col("content_with_context")), "character_count": T.utf16_length(F.col("content"))}).drop("__text", "__section", "__tail", "__longer")


def section_final(chunks: DataFrame) -> DataFrame:
    following = F.lead("section_id").over(_order())
    return chunks.withColumn("is_section_final", following.isNull() | (following != F.col("section_id")))


def fold(rows: list[dict], small: int = SMALL, target: int = TARGET) -> list[dict]:
    """Rows of one island: small ones join the row before, then a small row takes in the next. Ids of
    blocks and page numbers are united, if there; all else is of the first row."""

    def merged(a: dict, b: dict) -> dict:
        text = a["content"] + "\n\n" + b["content"]
        whole = a["breadcrumb_text"] + "\n\n" + text
        out = a | {"content": text, "content_with_context": whole, "token_count": count(whole), "n_blocks": a["n_blocks"] + b["n_blocks"]}
        if "character_count" in a:
            out["character_count"] = len(text.encode("utf-16-le")) // 2
        if "source_block_ids" in a:
            out["source_block_ids"] = [*a["source_block_ids"], *(i for i in b["source_block_ids"] if i not in set(a["source_block_ids"]))]
        if "page_numbers" in a:
            out["page_numbers"] = sorted({*a["page_numbers"], *b["page_numbers"]})
        return out

    def one_pass(todo: list[dict], is_small) -> list[dict]:
        out: list[dict] = []
        for r in todo:
            if out and is_small(out[-1], r) and out[-1]["token_count"] + r["token_count"] <= target:
                out[-1] = merged(out[-1], r)
            else:
                out.append(r)
        return out

    return one_pass(one_pass(rows, lambda _, r: r["token_count"] < small), lambda a, _: a["token_count"] < small)


def merge_small(chunks: DataFrame, small: int = SMALL, target: int = TARGET) -> DataFrame:
    """Merges within islands: maximal runs of one section without captions, which no merge can cross.
    Of the columns in CARRIED, those that chunks has go along."""
    edge = F.coalesce((F.lag("section_id").over(_order()) != F.col("section_id")) | F.col("is_figure_caption") | F.lag("is_figure_caption").over(_order()), F.lit(True))
    keep = ["document_id", "page", "block", "part", "section_id", "is_figure_caption", "breadcrumb_text", "content", "content_with_context", "token_count", *(c for c in CARRIED if c in chunks.columns)]
    islands = chunks.select(*keep, F.lit(1).cast("long").alias("n_blocks"), F.sum(edge.cast("int")).over(_order()).alias("island"))

    def fold_islands(pdf: pd.DataFrame, begins: np.ndarray) -> pd.DataFrame:
        """Only islands of several rows with a small one among them are folded; all others pass as they are."""
        ends = np.append(begins[1:], len(pdf))
        few = np.add.reduceat((pdf["token_count"].to_numpy() < small).astype(np.int64), begins)
        todo = np.flatnonzero((ends - begins > 1) & (few > 0))
        stay = np.ones(len(pdf), bool)
        folded: list[dict] = []
        for i in todo:
            stay[begins[i] : ends[i]] = False
            folded += fold(pdf.iloc[begins[i] : ends[i]].to_dict("records"), small, target)
        return pd.concat([pdf[stay], pd.DataFrame(folded, columns=pdf.columns)]) if folded else pdf

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come in order; the last island of a batch may go on in the next one."""
        held = None
        for pdf in frames:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if len(pdf):
                key = pdf[["document_id", "island"]]
                begins = np.flatnonzero((key != key.shift()).any(axis=1).to_numpy())
                held = pdf.iloc[begins[-1] :].reset_index(drop=True)
                if len(begins) > 1:
                    yield fold_islands(pdf.iloc[: begins[-1]].reset_index(drop=True), begins[:-1])
        if held is not None:
            yield fold_islands(held, np.zeros(1, np.int64))

    # the windows have put each document into one partition, in order
    return islands.sortWithinPartitions("document_id", "page", "block", "part").mapInPandas(run, islands.schema).drop("island")


def index_by(chunks: DataFrame, key: str, order: str = "sequence_number") -> DataFrame:
    """key, chunk_ids in document order; an array column is exploded, an empty key is 'unknown'."""
    kind = dict(chunks.dtypes)[key]
    col = F.explode(key) if kind.startswith("array") else F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit("unknown"))
    rows = chunks.select("document_id", col.cast("string").alias("key") if not kind.startswith("array") else col.alias("key"), F.col(order).alias("__o"), "chunk_id")
    return rows.groupBy("document_id", "key").agg(F.transform(F.sort_array(F.collect_list(F.struct("__o", "chunk_id"))), lambda x: x["chunk_id"]).alias("chunk_ids"))


def summary(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("total_chunks"), F.count_if("is_figure_caption").alias("figure_captions"), F.coalesce(F.max("token_count"), F.lit(0)).alias("max_tokens"), F.floor(F.try_avg("token_count") + 0.5).alias("avg_tokens"), F.count_if(F.col("overlap_tokens") > 0).alias("with_overlap"))


def gates(chunks: DataFrame, source_blocks: DataFrame) -> DataFrame:
    """gate, value, passed, and how a report shows it (shown, threshold, details), of each quality gate; an
    empty chunk set fails what has no share. A block is covered if a chunk names it in source_block_ids or,
    without that column, has its page and block."""
    src = source_blocks.agg(F.count_if(processable()).alias("blocks"), F.count_if(F.col("block_type") == "figure_caption").alias("captions"))
    small = (F.col("token_count") < SMALL) & ~F.col("is_figure_caption") & ~F.col("is_section_final")
    # without the list, its text shows whether it is empty
    bare = F.size("breadcrumb") == 0 if "breadcrumb" in chunks.columns else F.col("breadcrumb_text").isin("", "[Context: Document Root]")
    got = section_final(chunks).agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.max("token_count"), F.lit(0)).alias("most"), F.max_by("chunk_id", F.struct("token_count", -F.col("sequence_number"))).alias("longest"),
        F.count_if(small).alias("n_small"), F.count_if(bare).alias("bare"), F.count_if("is_figure_caption").alias("caption_chunks"),
    )
    named = chunks.select("document_id", F.explode("source_block_ids").alias("id")) if "source_block_ids" in chunks.columns else chunks.select("document_id", "page", "block")
    row = got.join(F.broadcast(src), F.lit(True)).join(F.broadcast(named.distinct().agg(F.count(F.lit(1)).alias("covered"))), F.lit(True))  # one row each
    coverage = F.floor(F.try_divide(F.col("covered") * 100.0, F.col("blocks")) + 0.5)
    share = F.try_divide(F.col("n_small") * 100.0, F.col("total"))
    with_crumb = F.floor(F.try_divide((F.col("total") - F.col("bare")) * 100.0, F.col("total")) + 0.5)
    percent = lambda x: F.concat(F.coalesce(x.cast("long").cast("string"), F.lit("NaN")), F.lit("%"))
    none = F.lit(None).cast("string")

    def gate(name: str, value: Column, ok: Column, shown: Column, threshold: Column, details: Column = none) -> Column:
        return F.struct(F.lit(name).alias("gate"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("passed"), shown.cast("string").alias("shown"), threshold.cast("string").alias("threshold"), details.alias("details"))

    all_ = F.array(
        gate("content_coverage", coverage, coverage >= 100, percent(coverage), F.lit("100%"), F.format_string("%d/%d blocks covered", "covered", "blocks")),
        gate("max_token_limit", F.col("most"), F.col("most") <= HARD, F.col("most"), F.lit(HARD), F.when(F.col("most") > HARD, F.format_string("Chunk %s exceeds limit", "longest"))),
        gate("min_token_check", share, share < 1, F.col("n_small"), F.lit("<1%"), F.when(F.col("n_small") > 0, F.format_string(f"%d chunks below {SMALL} tokens (%.2f%% - excluding section-final)", F.col("n_small"), share))),
        gate("breadcrumb_coverage", F.col("bare"), F.col("bare") == 0, percent(with_crumb), F.lit("100%")),
        gate("figure_captions", F.col("caption_chunks"), F.col("caption_chunks") >= F.col("captions"), F.col("caption_chunks"), F.col("captions")),
        gate("schema_validation", F.lit(1), F.lit(True), F.lit("valid"), F.lit("valid")),
    )
    return row.select(F.inline(all_))


def violations(chunks: DataFrame) -> DataFrame:
    """Adds violations: the names of the contract rules that a row breaks; rules on columns that chunks
    lacks don't apply."""
    from .contracts import CHUNK as RULES
    from .contracts import broken

    rules = {name: ok for name, ok in RULES().items() if name in chunks.columns}
    return chunks.withColumn("violations", broken(rules))
