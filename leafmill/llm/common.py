"""What several operators of this subpackage share: the shared folder, written
tables, byte files there, and access to Arrow strings as numpy arrays."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, counted with the entries of their arrays, up to which a table may be broadcast: 16 MB
#: of longs, some hundred MB as a hash table of rows.
BROADCAST_ROWS = 2_000_000
#: What bounds the bytes of a batch that goes to Python; set for the session where it isn't, as 10,000 rows of
#: text, Spark's other bound, may be any size.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of text that one numpy pass takes at once; a longer text is a pass of its own.
SLICE_BYTES = 1 << 19
#: Bytes that are hashed at once: their 64-bit arrays stay in a core's cache.
HASH_BYTES = 1 << 16


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this application below spark.checkpoint.dir, which driver and executors
    share; the application's folder is deleted when it ends.

    Where that setting is missing, a local folder is used if all runs in one process (local[n], as in
    tests); anything else raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "leafmill-shared")
    own = f"{base.rstrip('/')}/leafmill-{context.applicationId}"
    per_process(f"shared-dir {own}", lambda: _delete_at_end(spark, own))
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(8 << 20))
    return f"{own}/{name}-{uuid.uuid4().hex}"


def _delete_at_end(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return fs.deleteOnExit(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: lineage ends here."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(df: DataFrame, drop: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """df without the column to drop, under names that no working column of an operator has, and those names
    by the columns' own, in order."""
    own = {c: f"c{i}_{uuid.uuid4().hex}" for i, c in enumerate(c for c in df.columns if c != drop)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), own


def small(df: DataFrame, limit: int | None = None, weight: Column | None = None) -> DataFrame:
    """df, marked for broadcast only if its counted rows, or the sum of their weights, stay
    within the limit (BROADCAST_ROWS); Spark shuffles for the join beyond. A weight holds what a row
    with an array counts for."""
    limit = BROADCAST_ROWS if limit is None else limit
    size = df.limit(limit + 1).count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df


#: How Hadoop and Arrow name the same store.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "wasb://": "abfs://", "wasbs://": "abfss://"}


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a URI of Hadoop's; credentials for remote stores come from the executors'
    environment."""
    for theirs, ours in _SCHEMES.items():
        if uri.startswith(theirs):
            uri = ours + uri.removeprefix(theirs)
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def give_back() -> None:
    """Returns freed memory of this Python worker to the system: idle workers stay alive, and what they hold
    counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = per_process("malloc-trim", _malloc_trim)
    if trim:
        trim(0)


def _malloc_trim():
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return None


def tidy(run):
    """A function for mapInArrow that gives memory back when its task's rows end."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


class ByteWriter:
    """A file in the shared folder. Its name is new for each attempt of a task, and
    only rows of the attempt that counts name it, so a retry or a lost executor
    never mixes two versions."""

    def __init__(self, folder: str, suffix: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
        fs, path = _filesystem(self.uri)
        fs.create_dir(os.path.dirname(path), recursive=True)
        self._out, self.size = fs.open_output_stream(path, compression=None), 0

    def write(self, data: bytes) -> int:
        """Appends; returns where the data begin."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()


def read_range(uri: str, offset: int, length: int) -> bytes:
    fs, path = _filesystem(uri)
    with fs.open_input_file(path) as f:
        return f.read_at(length, offset)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return off - off[0], data


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of an Arrow list column; null counts as empty."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    return np.append(0, np.cumsum(sizes, dtype=np.int64)), column.flatten().to_numpy(zero_copy_only=False)


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold at most limit bytes together, or one row."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


#: Where a long text may be cut: before the blank.
_CUT = re.compile(rb"[A-Za-z](?= [A-Za-z])")


def pieces(off: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(a, b, lo, hi): texts a to b, which stand in data[lo:hi], or a piece of one long text. A text is cut
    only before a blank between two ASCII letters, where words and pre-tokens always end."""
    for a, b in slices(off):
        lo, end = int(off[a]), int(off[b])
        while end - lo > 2 * SLICE_BYTES:
            met = _CUT.search(data, lo + SLICE_BYTES, end)
            if met is None:
                break
            yield a, b, lo, met.start() + 1
            lo = met.start() + 1
        yield a, b, lo, end


def fmix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BASE = 0x9E3779B97F4A7C15


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64."""

    def make(base: int) -> np.ndarray:
        p = np.full(SLICE_BYTES + 1, base, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return per_process("powers", lambda: (make(_BASE), make(pow(_BASE, -1, 1 << 64))))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each codes[start:end] (in order, apart, none of them empty); equal spans hash alike
    wherever they stand. Arrays of about HASH_BYTES codes are held at once, or SLICE_BYTES of one longer span."""
    power, inverse = _powers()
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        lo = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, lo + HASH_BYTES, side="right")))
        if ends[b - 1] - lo > SLICE_BYTES:  # one long span, in pieces
            shift = np.ones(1, np.uint64)
            total = np.zeros(1, np.uint64)
            for i in range(lo, int(ends[a]), SLICE_BYTES):
                piece = codes[i : min(i + SLICE_BYTES, int(ends[a]))].astype(np.uint64) + np.uint64(1)
                total += (piece * power[: len(piece)]).sum(dtype=np.uint64) * shift
                shift *= power[SLICE_BYTES]
            out[a] = total[0]
        else:
            sums = np.zeros(int(ends[b - 1]) - lo + 1, np.uint64)
            np.cumsum((codes[lo : ends[b - 1]].astype(np.uint64) + np.uint64(1)) * power[: len(sums) - 1], out=sums[1:])
            out[a:b] = (sums[ends[a:b] - lo] - sums[starts[a:b] - lo]) * inverse[starts[a:b] - lo]
        a = b
    return fmix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words [^ \\t-\\r]+ of the texts start and stop."""
    starts, stops, before = [], [], False
    for lo in range(0, len(data), SLICE_BYTES):
        word = ~_BLANK[data[lo : lo + SLICE_BYTES]]
        prior = np.append(before, word[:-1])
        edges = off[np.searchsorted(off, lo) : np.searchsorted(off, lo + len(word))] - lo
        edge = np.zeros(len(word), bool)
        edge[edges] = True
        starts.append(np.flatnonzero(word & (~prior | edge)) + lo)
        stops.append(np.flatnonzero(prior & (~word | edge)) + lo)
        before = bool(word[-1])
    stops.append(np.array([len(data)] * before, np.int64))
    return (np.concatenate(starts) if starts else np.zeros(0, np.int64)), np.concatenate(stops).astype(np.int64)


def frame(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def per_process(key: str, make):
    """make()'s value, made once in a Python worker process and kept there."""
    import sys

    kept = sys.__dict__.setdefault("_leafmill_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
