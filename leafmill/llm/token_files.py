"""Token counts by a separator scan over flat token files.

A token file is nothing but ids (unsigned 16 bits, little endian), each document followed by
an end-of-document id; there is no index. count_tokens() cuts files into blocks, searches each
block for separators in one vectorised pass, and stitches documents that cross blocks with a
prefix scan: a running sum gives the tokens and separators before a block, a running maximum
the place of the last separator before it. So a document of any length costs no more than its blocks.

write_token_files() makes such files from texts; each task writes its own and returns, for each
file, its path, bytes and the ids of its documents in order.

Edge cases: null or empty text is a document of 0 tokens; null ids and repeated rows are
documents of their own; a file that doesn't end with a separator has a last document with
terminated = false; an empty file or table gives no rows. A file with an odd byte raises.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import load_ranks
from .common import ByteWriter, cut, per_process, pieces, read_range, shared_dir, tidy, utf8

EOD = 50256
BLOCK_BYTES, FILE_BYTES = 8 << 20, 64 << 20


def _write(folder: str, ranks_path: str, pattern: str, eod: int):
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = per_process(f"token-files {ranks_path}", lambda: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={}))
        out, ids, mark = None, [], np.array([eod], "<u2").tobytes()
        for batch in batches:
            keys, (off, data) = batch.column(0).to_pylist(), utf8(batch.column(1))
            raw = data.tobytes()
            for a, b, lo, hi in pieces(off, raw):
                out = out or ByteWriter(folder, ".tokens")
                bounds = np.clip(off[a : b + 1], lo, hi)
                for i in range(b - a):
                    out.write(np.array(encoder.encode_ordinary(raw[bounds[i] : bounds[i + 1]].decode("utf-8", "replace")), "<u2").tobytes())
                    if bounds[i + 1] == off[a + i + 1]:  # the text ends here, not a piece of it alone
                        out.write(mark)
                        ids.append(keys[a + i])
                if bounds[-1] == off[b] and out.size >= FILE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": out.uri, "bytes": out.size, "doc_ids": ids}], schema=schema)
                    out, ids = None, []
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": out.uri, "bytes": out.size, "doc_ids": ids}], schema=schema)

    return run


def write_token_files(docs: DataFrame, ranks_path: str, pattern: str, folder: str | None = None, eod: int = EOD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files now; returns path, bytes, doc_ids of each (a written table)."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return cut(narrow.mapInArrow(tidy(_write(folder or shared_dir(spark, "tokens"), ranks_path, pattern, eod)), "path string, bytes long, doc_ids array<long>"), "token-files")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, bytes of the files below a folder; their content isn't read."""
    return spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))


def _scan(eod: int):
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("tokens", pa.int64()), ("last", pa.int64()), ("lengths", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                raw = read_range(r["path"], r["offset"], r["size"])
                if len(raw) % 2:
                    raise ValueError(f"{r['path']} doesn't hold whole tokens")
                at = np.flatnonzero(np.frombuffer(raw, "<u2") == eod)
                row = {"path": r["path"], "block": r["block"], "tokens": len(raw) // 2, "last": int(at[-1]) if len(at) else None, "lengths": np.diff(at, prepend=-1) - 1}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


def count_tokens(files: DataFrame, eod: int = EOD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """files: path, bytes. One row per document: path, ordinal in its file, n_tokens, terminated."""
    blocks = files.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / block_bytes))).alias("block"))
    blocks = blocks.select("path", "block", (F.col("block") * block_bytes).alias("offset"), F.least(F.lit(block_bytes), F.col("bytes") - F.col("block") * block_bytes).alias("size"))
    # blocks are dealt out anew, as a file's blocks stand together
    found = blocks.repartition("path", "block").mapInArrow(tidy(_scan(eod)), "path string, block long, tokens long, last long, lengths array<long>")
    found = cut(found, "token-blocks")
    # the scan sees four numbers of each block; the documents' lengths stay where they are until then
    w = Window.partitionBy("path").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("path", "block", "tokens", "last", F.size("lengths").alias("ends"))
    scan = scan.withColumns({"start": F.coalesce(F.sum("tokens").over(before), F.lit(0)), "ordinal": F.coalesce(F.sum("ends").over(before), F.lit(0)), "final": F.lead("block").over(w).isNull()})
    scan = scan.withColumn("after", F.col("start") + F.col("last") + 1)
    scan = scan.withColumn("open", F.col("start") - F.coalesce(F.max("after").over(before), F.lit(0)))
    scan = cut(scan.drop("start", "after"), "token-scan")
    lengths = found.select(F.col("path").alias("l_path"), F.col("block").alias("l_block"), "lengths")
    placed = scan.join(lengths, (F.col("path") == F.col("l_path")) & (F.col("block") == F.col("l_block")))
    whole = placed.select("path", "ordinal", "open", F.posexplode("lengths").alias("k", "n")).select("path", (F.col("ordinal") + F.col("k")).alias("ordinal"), (F.col("n") + F.when(F.col("k") == 0, F.col("open")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("terminated"))
    left = F.when(F.col("last").isNull(), F.col("open") + F.col("tokens")).otherwise(F.col("tokens") - F.col("last") - 1)
    rest = scan.filter("final").select("path", (F.col("ordinal") + F.col("ends")).alias("ordinal"), left.alias("n_tokens"), F.lit(False).alias("terminated")).filter("n_tokens > 0")
    return whole.unionAll(rest)
