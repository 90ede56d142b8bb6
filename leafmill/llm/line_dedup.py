"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that aren't blank, each hashed after white space at its ends is
removed. A window is a shortest run that would be deleted: from each line on, and up to each line, as many lines
as it takes to have min_lines lines or min_words words. The least hash of a window (the rightmost of equals)
is its fingerprint: equal runs, wherever they stand, have the same lines selected. The selected lines of all
documents are counted by hash; a line that stands once is in no run that stands twice.
At the places of all others, the windows that have selected them meet by a hash of the whole window, as a line
alone may have its first place among other neighbours; each meets its first place in the corpus
(by document id, then line), and from there the match is extended both ways, line by line, as long as lines agree.
The later occurrence is deleted.

So a line goes exactly if it lies in a run of at least min_lines lines or min_words words that stands at an
earlier place too: such a run is covered by windows, and each of them has a first place. The first occurrence of
any line is never deleted. Windows meet their first place alone, so a line in a third of
all documents costs one row for each occurrence, and joins on it can be split.

That rule ends at line breaks. With passage_words, passages of that many words that begin or end inside lines go
as well: see passages.py.

Nor does it see shorter runs: with single_words, lines of that many words that stand in several documents go by
themselves. Shorter ones that stand alone or in pairs stay.

Edge cases: null text has no lines and stays null; an empty text stays. Blank lines stay
where they are. Rows that share an id are documents of their own, in the order of their texts' hashes; of equal
rows one is the first. Rows with a null id keep their texts and take no part. A text that loses all its
lines becomes empty and its row stays. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fmix, lists, shielded, slices, small, span_hashes, tidy, utf8, word_spans
from .passages import ROW, again, firsts, joined, passages

MIN_LINES, MIN_WORDS, PASSAGE_WORDS, SINGLE_WORDS = 3, 50, 50, 5
#: Windows of lines that one numpy pass takes at once.
WINDOWS = 1 << 16


def lines_of(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts' lines that aren't blank: their numbers, hashes and counts of words, and where each
    text's begin and the last one's end."""
    starts, stops = word_spans(off, data)
    breaks = np.flatnonzero(data == 10)
    head = np.unique(np.searchsorted(starts, np.concatenate([breaks, off[:-1]])))  # the first words after a break or in a text
    head = head[head < len(starts)]
    last = np.append(head, len(starts))[1:]
    text = np.searchsorted(off, starts[head], side="right") - 1
    number = np.searchsorted(breaks, starts[head]) - np.searchsorted(breaks, off[text])
    return number.astype(np.int32), span_hashes(data, starts[head], stops[last - 1]), (last - head).astype(np.int32), np.searchsorted(text, np.arange(len(off)))


def windows(words: np.ndarray, first: np.ndarray, min_lines: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The shortest runs that are long enough, from each line on and up to each line, as begins and ends."""
    n = len(words)
    total, at = np.append(0, np.cumsum(words, dtype=np.int64)), np.arange(n)
    begin, end = np.repeat(first[:-1], np.diff(first)), np.repeat(first[1:], np.diff(first))  # of each line's text
    on = np.minimum(at + min_lines, np.searchsorted(total, total[:-1] + min_words))
    back = np.maximum(at + 1 - min_lines, np.searchsorted(total, total[1:] - min_words, side="right") - 1)
    both = np.concatenate([(at * (n + 1) + on)[on <= end], (back * (n + 1) + at + 1)[back >= begin]])
    return np.divmod(np.unique(both), n + 1)


def fingerprints(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the place of its least hash, the rightmost of equals, and a hash of the whole window."""
    at, keys = begins.copy(), np.zeros(len(begins), np.uint64)
    for o in range(int((ends - begins).max(initial=0))):
        inside = begins + o < ends
        value = hashes[np.minimum(begins + o, len(hashes) - 1)]
        at = np.where(inside & (value <= hashes[at]), begins + o, at)
        keys += np.where(inside, value * (fmix(np.full(1, o + 1, np.uint64)) | np.uint64(1)), np.uint64(0))
    return at, fmix(keys + (ends - begins).astype(np.uint64))


def runs(own: np.ndarray, words: np.ndarray, first: np.ndarray, seeds: np.ndarray, shift: int, min_lines: int, min_words: int) -> list[tuple[int, int]]:
    """Ranges of own that match first along own[i] == first[i - shift] around the seeds and are long enough."""
    lo, hi = max(0, shift), min(len(own), len(first) + shift)
    equal = np.flatnonzero(np.diff(np.concatenate([[0], (own[lo:hi] == first[lo - shift : hi - shift]).astype(np.int8), [0]])))
    out, seeds = [], np.sort(seeds)
    for a, b in equal.reshape(-1, 2) + lo:
        if np.searchsorted(seeds, a) < np.searchsorted(seeds, b) and (b - a >= min_lines or words[a:b].sum() >= min_words):
            out.append((int(a), int(b)))
    return out


def _lists(parts: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(parts, kind))


def _lines(min_lines: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            for a, b in slices(off):
                numbers, hashes, words, first = lines_of(off[a : b + 1] - off[a], data[off[a] : off[b]])
                marks = np.unique(fingerprints(hashes, *windows(words, first, min_lines, min_words))[0])
                owner = np.searchsorted(first, marks, side="right") - 1
                of = np.searchsorted(owner, np.arange(b - a + 1))
                places = (marks - first[owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(numbers, first, pa.int32()), _lists(hashes.view(np.int64), first, pa.int64()), _lists(words, first, pa.int32()), _lists(again(np.repeat(np.arange(b - a), np.diff(first)), hashes, np.arange(len(hashes)), 1), first, pa.bool_()), _lists(places, of, pa.int32()), _lists(hashes[marks].view(np.int64), of, pa.int64())], names=["id", "numbers", "hashes", "words", "again", "marks", "keys"])

    return run


def _values(column: pa.Array) -> list[np.ndarray]:
    off, flat = np.asarray(column.offsets), np.asarray(column.values)
    return [flat[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]


def _windows(min_lines: int, min_words: int):
    """(id, at, hash) of the windows whose least hash stands at one of the given places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (first, hashes), (_, words), (spots_of, spots) = (lists(batch.column(c)) for c in (1, 2, 3))
            begins, ends = windows(words, first, min_lines, min_words)
            wanted = np.zeros(len(words), bool)
            wanted[spots + np.repeat(first[:-1], np.diff(spots_of))] = True
            # WINDOWS at once, as a batch may hold many lines
            for a in range(0, len(begins), WINDOWS):
                at, keys = fingerprints(hashes.view(np.uint64), begins[a : a + WINDOWS], ends[a : a + WINDOWS])
                at, keys = at[wanted[at]], keys[wanted[at]]
                owner = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array((at - first[owner]).astype(np.int32)), pa.array(keys.view(np.int64))], names=["id", "at", "hash"])

    return run


def _extend(min_lines: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, gone = [], []
            for i, (shift, seeds, numbers, hashes, words, first) in enumerate(zip(batch.column(1).to_pylist(), *(_values(batch.column(c)) for c in range(2, 7)), strict=True)):
                if found := runs(hashes, words, first, seeds, shift, min_lines, min_words):
                    rows.append(i)
                    gone.append(np.concatenate([numbers[a:b] for a, b in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(gone, pa.list_(pa.int32()))], names=["id", "gone"])

    return run


def singles(known: DataFrame, least: int, copies: bool) -> DataFrame:
    """(id, gone): the lines of that many words at least that stand in several documents, but for their first places."""
    rows = known.select("id", "hashes", "again", "numbers", F.posexplode("words").alias("k", "n")).filter(F.col("n") >= least).select("id", *(F.col(c)[F.col("k")].alias(n) for c, n in (("hashes", "hash"), ("again", "again"), ("numbers", "number"))))
    # a line that stands again in one document alone stays
    spread = [F.min("id.id"), F.max("id.id"), F.min("id.copy"), F.max("id.copy")]
    shared = rows.groupBy(F.col("hash").alias("s_hash")).agg(*[x.alias(n) for x, n in zip(spread, ("lo", "hi", "first_copy", "last_copy"), strict=True)]).filter("lo < hi OR first_copy < last_copy").select("s_hash")
    several = rows.join(small(cut(shared, "single-shared")), F.col("hash") == F.col("s_hash")).select(*rows.columns)
    return firsts(cut(several, "single-lines"), copies).groupBy("id").agg(F.collect_list("number").alias("gone"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, passage_words: int | None = None, single_words: int | None = None) -> DataFrame:
    """docs with the text column shortened, in the same columns, and __removed: the lines deleted, or shortened
    by passages of passage_words words inside lines, if given. With single_words, a line of that many words that
    stands in several documents stays at its first place alone. A column of docs named __removed is replaced."""
    docs, names = shielded(docs, drop="__removed")
    id_col, text_col = names[id_col], names[text_col]
    key, body = F.col(id_col).cast("long"), F.col(text_col)
    row: Callable = lambda text, copy: F.struct(key.alias("id"), text.alias("text"), copy.alias("copy"))
    alone = row(F.lit(0).cast("long"), F.lit(0).cast("long"))
    twice = cut(docs.select(key.alias("__twice")).filter("__twice IS NOT NULL").groupBy("__twice").count().filter("count > 1").select("__twice"), "line-ids")
    parts = [docs]
    if twice.take(1):
        # rows that share an id are told apart in a written copy, in which each has a number
        few_ids = small(twice)
        copies = docs.join(few_ids, key == F.col("__twice"), "left_semi").withColumn("__copy", F.monotonically_increasing_id() + 1)
        parts = [docs.join(few_ids, key == F.col("__twice"), "left_anti"), cut(copies, "line-again")]
    rows = [alone, row(F.xxhash64(body.cast("string")), F.col("__copy") if len(parts) > 1 else F.lit(0))]
    texts = functools.reduce(DataFrame.unionAll, (d.filter(key.isNotNull()).select(r.alias("id"), body.cast("string").alias("body")) for d, r in zip(parts, rows)))
    known = cut(texts.mapInArrow(tidy(_lines(min_lines, min_words)), f"id {ROW}, numbers array<int>, hashes array<long>, words array<int>, again array<boolean>, marks array<int>, keys array<long>"), "lines")
    marks = known.select("id", "marks", F.posexplode("keys").alias("k", "hash")).select("id", F.col("marks")[F.col("k")].alias("at"), "hash")
    # combined before the shuffle: one row for each hash and task
    shared = cut(marks.groupBy(F.col("hash").alias("s_hash")).count().filter("count > 1").select("s_hash"), "line-shared")
    spots = cut(marks.join(small(shared), F.col("hash") == F.col("s_hash")).groupBy(F.col("id").alias("s_id")).agg(F.collect_list("at").alias("spots")), "line-spots")
    around = known.join(small(spots, weight=F.size("spots") + 3), F.col("id") == F.col("s_id")).select("id", "hashes", "words", "spots")
    found = cut(around.mapInArrow(tidy(_windows(min_lines, min_words)), f"id {ROW}, at int, hash long"), "line-windows")
    place = found.groupBy(F.col("hash").alias("f_hash")).agg(F.min(F.struct("id", "at")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    place = cut(place.select("f_hash", F.col("f.id").alias("first_id"), F.col("f.at").alias("first_at")), "line-firsts")
    met = found.join(place, F.col("hash") == F.col("f_hash")).filter("id > first_id OR (id = first_id AND at > first_at)")
    pairs = cut(met.groupBy("id", "first_id", (F.col("at") - F.col("first_at")).alias("shift")).agg(F.collect_set("at").alias("seeds")), "line-pairs")
    first = known.select(F.col("id").alias("f_id"), F.col("hashes").alias("first_hashes"))
    own = known.select(F.col("id").alias("o_id"), "numbers", "hashes", "words")
    both = pairs.join(first, F.col("first_id") == F.col("f_id")).join(own, F.col("id") == F.col("o_id")).select("id", "shift", "seeds", "numbers", "hashes", "words", "first_hashes")
    gone = both.mapInArrow(tidy(_extend(min_lines, min_words)), f"id {ROW}, gone array<int>")
    if single_words:
        gone = gone.unionAll(singles(known, single_words, len(parts) > 1))
    gone = gone.groupBy(F.col("id").alias("__of")).agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("__gone"))
    gone = cut(gone, "line-gone")
    # counted with their lines: texts are only shuffled if the list is too long to broadcast
    few = small(gone, weight=F.size("__gone") + 3)
    if passage_words:
        spans = passages(texts.filter("body IS NOT NULL").join(few, F.col("id") == F.col("__of"), "left").select("id", "body", F.col("__gone").alias("gone")), passage_words, len(parts) > 1)
        spans = small(spans, weight=F.size("__starts") * 2 + 4)

    def shortened(part: DataFrame, of: Column) -> DataFrame:
        out = part.join(few, of == F.col("__of"), "left")
        lines = F.split(body, "\n", -1)
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        kept = F.transform(F.array(lines), lambda every: F.array_join(F.transform(stay, lambda i: every[i]), "\n"))[0]
        text, removed = F.when(F.col("__gone").isNull(), body).otherwise(kept), F.coalesce(F.size("__gone"), F.lit(0))
        if passage_words:
            out = out.join(spans, of == F.col("__in"), "left")
            text, removed = F.when(F.col("__in").isNull(), text).otherwise(joined(body)), F.coalesce("__changed", removed)
        return out.withColumns({text_col: text, "__removed": removed}).select(*docs.columns, "__removed")

    return functools.reduce(DataFrame.unionAll, (shortened(d, r) for d, r in zip(parts, rows))).toDF(*names, "__removed")
