"""Exact top-k inner products by MaxScore over dense integer vectors.

A term is a dimension, and each vector stands in the postings of all of them. Within a shard, a
dimension's least and largest value bound what it can add to a query's score. Dimensions are sorted
by the width of that range. The essential ones are the shortest head of this order without which
no vector can reach the current k-th score: the least that the head adds and the most that the
others can add together lie below it. Their postings are traversed for the whole shard; the others
are probed, widest first, only for vectors still competitive. A task hands each query's k-th score
on from shard to shard, so only its first shard is traversed whole. Tasks' best are merged.

Queries are sent to all tasks in rounds of about QUERY_BYTES, and each round reads the table
again: no vector is shuffled, and what is sent doesn't grow with the table. Scores are exact integers.

A query's own row is searched like any other, for k + 1 places, and taken out at the end: a row of
its id with the score of its vector by itself, of which there is one at least.

Edge cases: vectors that are null or hold a null or non-finite component, and rows with a null
id, take no part; vectors of another length than the query's are no candidates for it; rows that
share an id are queries and candidates of their own, so several lists may have one query_id; equal
scores go to the smaller id; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shared_dir, tidy

SHARD_ROWS, QUERY_ROWS, CHUNK = 2048, 256, 8
#: Bytes of query vectors that are sent at once, about.
QUERY_BYTES = 32 << 20


def _cells(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors as whole numbers) of the rows, for each length of vector."""
    ids, lists = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1)
    off, values = np.asarray(lists.offsets, np.int64), np.asarray(lists.values, np.float64)
    for dim in np.unique(np.diff(off)):
        at = np.flatnonzero(np.diff(off) == dim)
        big = np.floor(scale * values[off[at][:, None] + np.arange(dim)])
        if big.size and np.abs(big).max() >= 2**62:
            raise ValueError("a component is too large for integer scores")
        yield ids[at], big.astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch], rows: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors of one length), rows at a time."""
    held: dict[int, list] = {}
    for batch in batches:
        for ids, cells in _cells(batch, scale):
            for a in range(0, len(ids), rows):
                parts = held.setdefault(cells.shape[1], [])
                parts.append((ids[a : a + rows], cells[a : a + rows]))
                if sum(len(p[0]) for p in parts) >= rows:
                    del held[cells.shape[1]]
                    yield tuple(map(np.concatenate, zip(*parts, strict=True)))
    for parts in held.values():
        yield tuple(map(np.concatenate, zip(*parts, strict=True)))


def _blocks(rows: int, scale: float):
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, cells in _shards(batches, rows, scale):
            yield pa.RecordBatch.from_pylist([{"dim": cells.shape[1], "ids": ids.tobytes(), "cells": cells.tobytes()}], schema=schema)

    return run


def essential(low: np.ndarray, high: np.ndarray, floor) -> int:
    """How many dimensions, in the given order, are essential: without them a vector lacks floor. low, high:
    what each adds at least and at most."""
    least, rest = np.append(0, np.cumsum(low)), np.append(np.cumsum(high[::-1])[::-1], 0)
    short = np.flatnonzero((least + rest < floor).astype(bool))
    return int(short[0]) if len(short) else len(low)


def traverse(query: np.ndarray, by_dim: np.ndarray, low: np.ndarray, high: np.ndarray, floor) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows, their scores) of the shard's vectors that reach floor, and how many postings were read. by_dim: a
    row for each dimension; low, high: its least and largest value."""
    a, b = query * low, query * high
    least, most = np.minimum(a, b), np.maximum(a, b)
    order = np.argsort(-(most - least).astype(np.float64), kind="stable")
    at = essential(least[order], most[order], floor)
    left = np.append(np.cumsum(most[order][::-1])[::-1], 0)  # what dimensions from here on can add at most
    score = query[order[:at]] @ by_dim[order[:at]] if at < len(order) else query @ by_dim
    alive, read = np.arange(by_dim.shape[1]), at * by_dim.shape[1]
    while True:
        stay = (score + left[at] >= floor).astype(bool)
        if not stay.all():
            alive, score = alive[stay], score[stay]
        if at >= len(order) or not len(alive):
            return alive, score, read
        dims = order[at : at + CHUNK]
        score = score + query[dims] @ by_dim[np.ix_(dims, alive)]
        at += len(dims)
        read += len(dims) * len(alive)


class Block:
    """Queries of one length, and the best rows that they have met so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, object)) for _ in queries]
        self.read = 0

    def meet(self, ids: np.ndarray, cells: np.ndarray) -> None:
        dim, queries, by_dim = cells.shape[1], self.queries, np.ascontiguousarray(cells.T)
        top = float(np.abs(queries).max(initial=0)) * float(np.abs(by_dim).max(initial=0)) * dim
        # whole numbers below 2^53 are exact as floats
        kind = np.float64 if top < 2**53 else np.int64 if top < 2**62 else object
        by_dim, queries = by_dim.astype(kind), queries.astype(kind)
        low, high = by_dim.min(axis=1), by_dim.max(axis=1)
        for i, query in enumerate(queries):
            floor = self.best[i][1][-1] if len(self.best[i][0]) == self.k else -np.inf
            rows, score, read = traverse(query, by_dim, low, high, floor)
            self.read += read
            if len(rows) > self.k and kind is not object:  # all that tie with the k-th stay
                stay = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
                rows, score = rows[stay], score[stay]
            if len(rows):
                every, of = np.append(self.best[i][1], [int(x) for x in score]), np.append(self.best[i][0], ids[rows])
                first = sorted(range(len(of)), key=lambda j: (-every[j], of[j]))[: self.k]
                self.best[i] = of[first], every[first]


def _search(sent, k: int, scale: float):
    schema = pa.schema([(x, pa.int64()) for x in ("block", "row", "query_id", "own", "vec_id", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(key, dim, np.frombuffer(ids, np.int64), Block(np.frombuffer(cells, np.int64).reshape(-1, dim) if dim else np.zeros((len(ids) // 8, 0), np.int64), k)) for key, dim, ids, cells in sent.value]
        for ids, cells in _shards(batches, SHARD_ROWS, scale):
            for _, dim, _, block in blocks:
                if dim == cells.shape[1]:
                    block.meet(ids, cells)
        for key, _, ids, block in blocks:
            rows = [(key, i, int(q), sum(int(x) ** 2 for x in v), int(a), int(s)) for i, (q, v, (of, score)) in enumerate(zip(ids, block.queries, block.best, strict=True)) for a, s in zip(of, score, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(6)], schema=schema)

    return run


def topk(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where the column is_query holds, the k other
    rows with the largest inner product of floor(scale * component)."""
    spark = vectors.sparkSession
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.col(f"`{id_col}`").isNotNull() & vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.filter(fine).select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"), is_query.alias("asks"))
    asked = usable.filter("asks").select("id", "vec").coalesce(max(8, spark.sparkContext.defaultParallelism)).mapInArrow(tidy(_blocks(QUERY_ROWS, scale)), "dim int, ids binary, cells binary")
    asked = cut(asked.withColumn("block", F.monotonically_increasing_id()), "topk-queries")
    size = asked.agg(F.sum(F.length("cells") + F.length("ids"))).first()[0] or 0
    rounds, path = -(-size // query_bytes) or 1, shared_dir(spark, "topk-found")
    for r in range(rounds):
        part = asked.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r).select("block", "dim", "ids", "cells")
        sent = spark.sparkContext.broadcast([tuple(x) for x in part.collect()])
        usable.select("id", "vec").mapInArrow(tidy(_search(sent, k + 1, scale)), "block long, row long, query_id long, own long, vec_id long, score long").write.mode("append").parquet(path)
        sent.unpersist()
    found = spark.read.schema("block long, row long, query_id long, own long, vec_id long, score long").parquet(path)
    of_query = Window.partitionBy("block", "row")
    ranked = found.withColumn("at", F.row_number().over(of_query.orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("at") <= k + 1)
    own = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("at"))).over(of_query)
    others = ranked.withColumn("self", F.coalesce(own, F.lit(k + 2))).filter(F.col("at") != F.col("self"))
    others = others.withColumn("rank", (F.col("at") - (F.col("at") > F.col("self")).cast("int")).cast("int")).filter(F.col("rank") <= k)
    return others.select("query_id", "rank", "vec_id", "score")
