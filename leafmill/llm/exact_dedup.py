"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each task normalises its texts, drops copies within its own block after comparing
   bytes, saves the block's distinct texts (sorted by 64-bit fingerprint) to the shared
   folder, and sends each owner of a fingerprint range a sorted Rice-coded list.
2. Each owner merges the lists and answers every list with a bitmap: which of its
   entries occur in another block too.
3. Only those suspects' texts are read back, by one byte range for each list, and
   shuffled; equality is confirmed on all bytes by an aggregate with map-side combine,
   so a group that holds a third of all rows arrives as one row for each task.

Edge cases: null text counts as empty, and empty texts are equal to each other. A null id
is never the largest one; a group of null ids alone has a null keep_id and keeps nothing.
Rows that share id and text are kept or dropped together. An empty table gives an empty
result. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ByteWriter, cut, give_back, read_range, shared_dir, tidy, utf8

#: Fingerprints that one owner should get, about, and rows whose copies a block counts before it is sent.
PER_OWNER, BLOCK_ROWS = 2_000_000, 200_000
#: Bytes of text that a block may hold before it is saved (a longer text is a block).
BLOCK_BYTES = 32 << 20
_SENT = "kind string, id long, sha string, local_id long, local_n long, block string, owner int, n int, payload binary, places binary"


def rice_encode(values: np.ndarray, low: int) -> bytes:
    """Sorted unsigned 64-bit values, all at least low, as Golomb-Rice coded gaps: a header
    (count, parameter), the unary quotients, then the remainders."""
    n = len(values)
    if not n:
        return b"\0" * 5
    gaps = np.diff(values, prepend=np.uint64(low))
    k = max(0, min(63, int(np.log2(max(1.0, float(values[-1] - np.uint64(low)) / n)))))
    stops = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    bits = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)[::-1]) & np.uint64(1)).astype(np.uint8)
    return n.to_bytes(4, "little") + bytes([k]) + np.packbits(unary).tobytes() + np.packbits(bits).tobytes()


def rice_decode(data: bytes, low: int) -> np.ndarray:
    n, k = int.from_bytes(data[:4], "little"), data[4]
    if not n:
        return np.zeros(0, np.uint64)
    rest = (n * k + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, len(data) - 5 - rest, 5))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8, rest, len(data) - rest))[: n * k].reshape(n, k).astype(np.uint64)
    remainders = (bits << np.arange(k, dtype=np.uint64)[::-1]).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) + remainders, dtype=np.uint64) + np.uint64(low)


def _send(folder: str, owner_bits: int):
    schema = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("sha", pa.string()), ("local_id", pa.int64()), ("local_n", pa.int64()), ("block", pa.string()), ("owner", pa.int32()), ("n", pa.int32()), ("payload", pa.binary()), ("places", pa.binary())])

    def flush(texts: dict[bytes, bytes], members: dict[bytes, list], docs: list) -> Iterator[pa.RecordBatch]:
        """texts: by SHA-256; members: its (largest id, count)."""
        order = sorted(texts)  # by digest, so by fingerprint as well
        out = ByteWriter(folder, ".block")
        ends, fps = np.zeros(len(order) + 1, np.int64), np.empty(len(order), np.uint64)
        for i, sha in enumerate(order):
            packed = pa.compress(texts[sha], codec="zstd", asbytes=True)
            out.write(len(texts[sha]).to_bytes(8, "little") + packed)
            ends[i + 1], fps[i] = out.size, int.from_bytes(sha[:8], "big")
        out.close()
        rows = [{"kind": "doc", "id": i, "sha": sha.hex(), "local_id": members[sha][0], "local_n": members[sha][1]} for i, sha in docs]
        owners = (fps >> np.uint64(64 - owner_bits)).astype(np.int64) if owner_bits else np.zeros(len(fps), np.int64)
        cuts = np.flatnonzero(np.diff(owners, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(fps)], strict=True):
            own = int(owners[a])
            ids = [members[s][0] for s in order[a:b]]
            places = np.concatenate([ends[a : b + 1], [members[s][1] for s in order[a:b]], [x is not None for x in ids], [x or 0 for x in ids]]).astype("<i8")
            rows.append({"kind": "list", "block": out.uri, "owner": own, "n": int(b - a), "payload": rice_encode(fps[a:b], own << (64 - owner_bits)), "places": places.tobytes()})
        for a in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_pylist(rows[a : a + 20_000], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[bytes, bytes] = {}
        members: dict[bytes, list] = {}
        docs: list = []
        size = 0
        for batch in batches:
            ids, (off, data) = batch.column(0).to_pylist(), utf8(batch.column(1))
            raw = data.tobytes()
            for i, key in enumerate(ids):
                text = raw[off[i] : off[i + 1]].lower()  # bytes: A-Z only
                sha = hashlib.sha256(text).digest()
                if sha in texts:
                    if texts[sha] != text:
                        raise ValueError(f"two texts with SHA-256 {sha.hex()}")
                    m = members[sha]
                    m[0] = key if m[0] is None else m[0] if key is None else max(m[0], key)
                    m[1] += 1
                else:
                    texts[sha], members[sha] = text, [key, 1]
                    size += len(text)
                docs.append((key, sha))
                if size >= BLOCK_BYTES or len(docs) >= BLOCK_ROWS:
                    yield from flush(texts, members, docs)
                    texts, members, docs, size = {}, {}, [], 0
        if docs:
            yield from flush(texts, members, docs)

    return run


def _own(owner_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(pdf["owner"].iloc[0]) << (64 - owner_bits)
        lists = [rice_decode(bytes(p), low) for p in pdf["payload"]]
        every, counts = np.unique(np.concatenate(lists), return_counts=True)
        double = every[counts > 1]
        found = [np.packbits(np.isin(x, double, assume_unique=True)).tobytes() for x in lists]
        del lists, every, counts
        give_back()
        return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "bitmap": found})

    return run


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each list, its marked entries' texts, by one read of the range that holds them."""
    for batch in batches:
        for row in batch.to_pylist():
            n, places = row["n"], np.frombuffer(row["places"], "<i8")
            marked = np.flatnonzero(np.unpackbits(np.frombuffer(row["bitmap"], np.uint8))[:n])
            if not len(marked):
                continue
            ends, count, has, ids = places[: n + 1], places[n + 1 : 2 * n + 1], places[2 * n + 1 : 3 * n + 1], places[3 * n + 1 :]
            first = int(ends[marked[0]])
            raw = read_range(row["block"], first, int(ends[marked[-1] + 1]) - first)
            out = {"sha": [], "body": [], "max_id": [], "n": []}
            for i in marked.tolist():
                entry = raw[int(ends[i]) - first : int(ends[i + 1]) - first]
                text = pa.decompress(entry[8:], int.from_bytes(entry[:8], "little"), codec="zstd", asbytes=True)
                for k, v in zip(out, (hashlib.sha256(text).hexdigest(), text, int(ids[i]) if has[i] else None, int(count[i])), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["sha"]), pa.array(out["body"], pa.binary()), pa.array(out["max_id"], pa.int64()), pa.array(out["n"], pa.int64())], names=list(out))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """One row per input row: <id>, keep_id, group_size, kept, text_sha256.

    owners: ranges of fingerprints, a power of two; by default two for each core, or as many as hold
    PER_OWNER rows each, if that is more.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
    if owners is None:
        owners = max(16, 2 * spark.sparkContext.defaultParallelism, -(-docs.count() // PER_OWNER))
    bits = max(0, int(owners) - 1).bit_length()
    folder = shared_dir(spark, "exact-blocks")
    sent = cut(narrow.mapInArrow(tidy(_send(folder, bits)), _SENT), "exact-sent")
    rows = sent.filter("kind = 'doc'").select("id", "sha", "local_id", "local_n")
    lists = sent.filter("kind = 'list'")
    bitmaps = lists.select("block", "owner", "payload").groupBy("owner").applyInPandas(_own(bits), "block string, owner int, bitmap binary")
    # the bitmaps go back to the blocks; places stay on the sender's side until then
    answered = lists.select("block", "owner", "n", "places").join(bitmaps, ["block", "owner"])
    suspects = answered.select("block", "n", "places", "bitmap").mapInArrow(tidy(_suspects), "sha string, body binary, max_id long, n long")
    whole: Column = F.when(F.min("body") == F.max("body"), F.max("max_id")).otherwise(F.raise_error(F.concat(F.lit("two texts with SHA-256 "), F.first("sha"))).cast("long"))
    classes = cut(suspects.groupBy(F.col("sha").alias("class_sha")).agg(whole.alias("class_id"), F.sum("n").alias("class_n")), "exact-classes")
    # a class of a thousandth of all rows or more is broadcast: there are a thousand of them at most
    total = rows.count()
    hot = F.col("class_n") * 1000 >= total
    many, few = F.broadcast(classes.filter(hot)), classes.filter(~hot)
    by_class = F.col("sha") == F.col("class_sha")
    joined = rows.join(many, by_class).unionAll(rows.join(many.select("class_sha"), by_class, "left_anti").join(few, by_class, "left"))
    keep = F.when(F.col("class_n").isNull(), F.col("local_id")).otherwise(F.col("class_id"))
    return joined.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("class_n", "local_n").alias("group_size"),
        F.coalesce(F.col("id") == keep, F.lit(False)).alias("kept"), F.col("sha").alias("text_sha256"),
    )
