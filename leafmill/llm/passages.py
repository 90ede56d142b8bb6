"""Repeated passages inside lines, by winnowing over word hashes.

A place is a window of `size` words, wherever lines break, of which the line rule has left a word.
A word goes exactly if it lies in a window that stands at an earlier place too (by document id, then word);
within a document the two must not overlap, so of a loop of words its first window stays.

1. Winnowing: a window's mark is the least hash of its half-windows of words. Windows in a row that share it are
   one entry. Equal windows have equal marks, so a window whose mark is of one entry alone can't repeat.
2. All windows whose mark is of several entries meet by the hash of the whole window, as a mark alone may have its
   first place among other words. Each hash meets its first place alone, so a passage in a third of
   all documents costs one row for each occurrence of a window.
3. What is left of a text is given as spans of its characters: a line keeps its other words and white space,
   a line that loses all its words goes, blank lines stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fmix, lists, slices, small, span_hashes, tidy, utf8, word_spans


def _window(values: np.ndarray, size: int, join) -> np.ndarray:
    """join over values[i : i + size] for each i, by doubling; join may meet a value twice."""
    m, out = 1, values
    while m * 2 <= size:
        out = join(out[:-m], out[m:])
        m *= 2
    return join(out[: len(out) - (size - m)], out[size - m :]) if m < size else out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return fmix(a * np.uint64(0x9E3779B97F4A7C15) + fmix(b))


def left_words(off: np.ndarray, data: np.ndarray, starts: np.ndarray, gone_of: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where all texts' lines begin, which is each text's first, where the lines' words begin (of all words, which begin
    at starts), and whether a word's line is left. gone: numbers of lines; gone_of: where each text's begin."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, off[:-1])  # breaks before a text
    begins = np.insert(breaks + 1, before, off[:-1])
    own = before + np.arange(len(before))
    first = np.searchsorted(starts, begins)
    stay = np.ones(len(begins), bool)
    stay[gone + np.repeat(own, np.diff(gone_of))] = False
    return begins, own, first, np.repeat(stay, np.diff(first, append=len(starts)))


def words_of(off: np.ndarray, data: np.ndarray, gone_of: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, whether their line is left, and where each text's words begin."""
    starts, stops = word_spans(off, data)
    return span_hashes(data, starts, stops), left_words(off, data, starts, gone_of, gone)[3], np.searchsorted(starts, off)


def places(left: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Whether a window that begins at the word lies in its text and has a word left."""
    n = len(left)
    ends = np.repeat(first[1:], np.diff(first))
    sums = np.concatenate([[0], np.cumsum(left)])
    at = np.arange(n)
    return (at + size <= ends) & (sums[np.minimum(at + size, n)] > sums[at])


def winnow(hashes: np.ndarray, ok: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number, mark) of the windows in a row that are places and share their mark, the least hash
    of a half-window. No entry has more windows than one half-window lies in, so windows that repeat
    without overlap are in two entries, also in a loop of words."""
    half = size // 2
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    most = size - half + 1
    least = np.where(ok[: len(hashes) - size + 1], _window(_window(hashes, half, _pair), most, np.minimum), np.uint64(0))
    at = np.flatnonzero(np.diff(least, prepend=np.uint64(0)))
    n = np.diff(at, append=len(least))
    at, n = at[least[at] > 0], n[least[at] > 0]
    parts = (n + most - 1) // most
    begin = np.repeat(at, parts) + most * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return begin, np.minimum(np.repeat(at + n, parts) - begin, most), least[begin]


#: A row: its document's id; rows that share one differ by their texts' hash and a number.
ROW = "struct<id: long, text: long, copy: long>"


#: Places of several ranges [at, at + n) of words or windows are held as at * SPAN + n.
SPAN = 1 << 32


def _entries(ids: pa.Array, owner: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each id that has entries, with their columns as lists. owner: the ids' places, rising."""
    head = np.flatnonzero(np.diff(owner, prepend=-1))
    off = pa.array(np.append(head, len(owner)).astype(np.int32))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owner[head])), *(pa.ListArray.from_arrays(off, pa.array(c)) for c in columns.values())], names=["id", *columns])


def _flat(entries: DataFrame, by: str, **names: str) -> DataFrame:
    """(id, hash, more columns): the entries, a row for each; more columns' lists by their names. Lists beside the
    exploded one are only reached into, never copied."""
    return entries.select("id", *names.values(), F.posexplode(by).alias("k", "hash")).select("id", "hash", *(F.col(c)[F.col("k")].alias(n) for n, c in names.items()))


def again(owner: np.ndarray, hashes: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """Whether the hash stands in the same text at least that far before. at: the places, rising within a text."""
    order = np.lexsort((at, hashes, owner))
    o, h, a = owner[order], hashes[order], at[order]
    head = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (h[1:] != h[:-1]))) if len(o) else np.zeros(0, np.int64)
    out = np.zeros(len(at), bool)
    out[order] = a - np.repeat(a[head], np.diff(np.append(head, len(a)))) >= least
    return out


def firsts(places: DataFrame, copies: bool) -> DataFrame:
    """places (id, hash, again, more columns) that aren't the first of their hash: those of a later document, or again
    in the same one. Only ids are compared, so the aggregate keeps numbers, in one row for each hash and task;
    rows that share an id, if there are copies, are put in order among themselves."""
    first = places.groupBy(F.col("hash").alias("f_hash")).agg(F.min("id.id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("f_hash", "first")
    number = F.col("id.id")
    met = places
    if not copies:  # the id's number is all of it
        met, number = places.withColumn("id", number), F.col("id")
    # written, so both sides of the join are plain exchanges, whose hot partitions Spark splits
    met = met.join(cut(first, "first-places"), F.col("hash") == F.col("f_hash"))
    later = (number > F.col("first")) | F.col("again")
    if copies:
        of_copies = places.filter("id.copy > 0").groupBy(F.col("hash").alias("c_hash"), F.col("id.id").alias("c_id")).agg(F.min("id").alias("c_first"))
        met = met.join(of_copies, (F.col("hash") == F.col("c_hash")) & (F.col("id.id") == F.col("c_id")), "left")
        later = later | F.coalesce(F.col("id") > F.col("c_first"), F.lit(False))
    met = met.filter(later)
    if not copies:
        met = met.withColumn("id", F.struct(number.alias("id"), *(F.lit(0).cast("long").alias(c) for c in ("text", "copy"))))
    return met.select(*places.columns)


def _marks(size: int):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            ids, (gone_of, gone) = batch.column(0), lists(batch.column(2))
            for a, b in slices(off):
                hashes, left, first = words_of(off[a : b + 1] - off[a], data[off[a] : off[b]], gone_of[a : b + 1], gone[gone_of[a] : gone_of[b]])
                at, n, keys = winnow(hashes, places(left, first, size), size)
                owner = np.searchsorted(first, at, side="right") - 1
                yield _entries(ids, owner + a, spans=(at - first[owner]) * SPAN + n, hashes=keys.view(np.int64))

    return run


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            ids, (gone_of, gone), (of, los), (_, his) = batch.column(0), *(lists(batch.column(k)) for k in (2, 3, 4))
            for a, b in slices(off):
                hashes, left, first = words_of(off[a : b + 1] - off[a], data[off[a] : off[b]], gone_of[a : b + 1], gone[gone_of[a] : gone_of[b]])
                if len(hashes) < size:
                    continue
                near = within(len(hashes), first, of[a : b + 1], los[of[a] : of[b]], his[of[a] : of[b]])
                at = np.flatnonzero(near & places(left, first, size))
                owner = np.searchsorted(first, at, side="right") - 1
                keys = _window(hashes, size, _pair)[at]
                yield _entries(ids, owner + a, ats=(at - first[owner]).astype(np.int32), hashes=keys.view(np.int64), agains=again(owner, keys, at, size))

    return run


def within(n: int, first: np.ndarray, of: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Whether a word lies in a range of its text. first: where the texts' words begin; of: where their ranges do."""
    begin = np.repeat(first[:-1], np.diff(of))
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, los + begin, 1)
    np.add.at(steps, his + begin, -1)
    return np.cumsum(steps[:-1]) > 0


def merged(of: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of each row's spans, at * SPAN + n, as begins and ends of ranges, and where each row's begin."""
    owner = np.repeat(np.arange(len(of) - 1), np.diff(of))
    order = np.lexsort((spans, owner))
    base = owner[order] * (2 * SPAN)  # rows apart
    at, n = np.divmod(spans[order], SPAN)
    lo, hi = at + base, np.maximum.accumulate(at + n + base)
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1])[: len(lo)])
    base = base[new]
    return lo[new] - base, hi[np.append(new[1:], len(hi))[: len(new)] - 1] - base, np.searchsorted(owner[order][new], np.arange(len(of)))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        los, his, of = merged(*lists(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(x.astype(np.int32))) for x in (los, his))], names=["id", "los", "his"])


def _ranged(spans: DataFrame, name: str) -> DataFrame:
    """(r_id, los, his): the ranges of each id's spans. A repeated passage is one range, however long."""
    rows = spans.groupBy("id").agg(F.collect_list("span").alias("spans"))
    return cut(rows.mapInArrow(tidy(_ranges), f"id {ROW}, los array<int>, his array<int>").withColumnRenamed("id", "r_id"), name)


def left_of(off: np.ndarray, data: np.ndarray, gone_of: np.ndarray, gone: np.ndarray, of: np.ndarray, los: np.ndarray, his: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts from 1, lengths) in bytes of what is left of the texts without those lines and ranges of words,
    where each text's begin, and how many lines of it went or were shortened."""
    starts, stops = word_spans(off, data)
    begins, own, first, keep = left_words(off, data, starts, gone_of, gone)
    keep &= ~within(len(starts), np.searchsorted(starts, off), of, los, his)
    text = np.repeat(np.arange(len(own)), np.diff(own, append=len(begins)))
    size = np.diff(first, append=len(starts))
    sums = np.append(0, np.cumsum(keep))
    kept = sums[first + size] - sums[first]
    stay = (kept > 0) | (size == 0)
    ends = np.append(begins[1:] - 1, len(data))
    ends[own[1:] - 1] = off[1:-1]  # no line break ends a text
    drop = np.zeros(len(data) + 1, np.int8)

    def without(a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(drop, a, 1)
        np.add.at(drop, b, -1)

    without(begins[~stay], ends[~stay])
    # a line break belongs to the line after it, and goes if no line before it stays
    total = np.cumsum(stay)
    alone = ~stay | (total - (total[own] - stay[own])[text] == 1)
    alone[own] = False
    without(begins[alone] - 1, begins[alone])
    # runs of words that go, of lines that stay: up to the next word, or from the last one before to the line's last
    line = np.repeat(np.arange(len(begins)), size)
    out = ~keep & stay[line]
    head = np.flatnonzero(out & ~((np.append(False, out[:-1])) & (np.diff(line, prepend=-1) == 0)))
    tail = np.flatnonzero(out & ~((np.append(out[1:], False)) & (np.diff(line, append=-1) == 0)))
    last = tail == (first + size)[line[tail]] - 1
    without(np.where(last, stops[head - 1], starts[head]), np.where(last, stops[tail], starts[np.minimum(tail + 1, len(starts) - 1)]))
    left = np.cumsum(drop[:-1], dtype=np.int8) == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    a = np.flatnonzero(left & (~np.append(False, left[:-1]) | edge[:-1]))
    b = np.flatnonzero(left & (~np.append(left[1:], False) | edge[1:])) + 1
    owner = np.searchsorted(off, a, side="right") - 1
    changed = np.bincount(text[kept < size], minlength=len(off) - 1)
    return a - off[owner] + 1, b - a, np.searchsorted(owner, np.arange(len(off))), changed


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        off, data = utf8(batch.column(1))
        (gone_of, gone), (of, los), (_, his) = (lists(batch.column(k)) for k in (2, 3, 4))
        for a, b in slices(off):
            starts, lengths, first, changed = left_of(off[a : b + 1] - off[a], data[off[a] : off[b]], gone_of[a : b + 1], gone[gone_of[a] : gone_of[b]], of[a : b + 1], los[of[a] : of[b]], his[of[a] : of[b]])
            first = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.ListArray.from_arrays(first, pa.array(x.astype(np.int32))) for x in (starts, lengths)), pa.array(changed.astype(np.int32))], names=["id", "starts", "lengths", "changed"])


def passages(texts: DataFrame, size: int, copies: bool = False) -> DataFrame:
    """Of each row of texts (id, body, gone: its lines that the line rule takes) that loses a passage:
    __in, its id; __starts and __lengths, the spans left; __changed, the lines that go or are shortened."""
    marks = cut(texts.mapInArrow(tidy(_marks(size)), f"id {ROW}, spans array<long>, hashes array<long>"), "passage-marks")
    marks = _flat(marks, "hashes", span="spans")
    twice = cut(marks.groupBy(F.col("hash").alias("t_hash")).count().filter("count > 1").select("t_hash"), "passage-twice")
    spots = _ranged(marks.join(small(twice), F.col("hash") == F.col("t_hash")), "passage-spots")
    met = lambda ranges: texts.join(small(ranges, weight=F.size("los") * 2 + 1), F.col("id") == F.col("r_id")).select("id", "body", "gone", "los", "his")
    windows = cut(met(spots).mapInArrow(tidy(_windows(size)), f"id {ROW}, ats array<int>, hashes array<long>, agains array<boolean>"), "passage-windows")
    later = firsts(_flat(windows, "hashes", at="ats", again="agains"), copies)
    later = _ranged(later.select("id", (F.col("at").cast("long") * SPAN + size).alias("span")), "passage-later")
    return cut(met(later).mapInArrow(tidy(_spans), f"id {ROW}, starts array<int>, lengths array<int>, changed int").toDF("__in", "__starts", "__lengths", "__changed"), "passage-spans")


def joined(body: Column) -> Column:
    """The spans of the text, joined. Bytes are reached at once, characters only by counting from the start."""
    cut_of = lambda raw: F.array_join(F.zip_with("__starts", "__lengths", lambda a, n: F.substring(raw, a, n).cast("string")), "")
    return F.transform(F.array(body.cast("binary")), cut_of)[0]
