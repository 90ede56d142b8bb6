"""MinHash near-dedup with odd sketches, confirmed on full shingle sets.

1. Signatures: a document's set of word shingles gives `bands * rows` MinHash values, a key
   for each band, and an odd sketch: a bitmap in which each (index, value) sample flips one
   bit. Copies with the same set are one class from here on, through an aggregate with
   map-side combine.
2. Buckets: classes that share a band key. Only buckets of two or more go on.
3. Candidates come from buckets in rounds. In a star round each member meets only its bucket's
   leader, and only if the two aren't in one component yet: first the text with most company in
   all its buckets, later another one each round, for as long as a twentieth of the pairs are
   links. So a bucket of n near copies costs n pairs, not n squared. At last, all pairs of a
   bucket that still lie in different components are taken if exact bounds allow a link: sizes,
   shingles that no other candidate has, and distances from the first leader. No candidate is
   dropped otherwise, but by the sketch: the XOR population count must allow a similarity of
   `threshold - margin`. Then the full sets are compared.
4. Links merge components by sending each node and its neighbours to the least of them.

With 32 bands of 6 rows, a pair at the similarity 0.85 misses every band with probability
3e-7, and the sketch's margin of 0.15 is 5.8 standard deviations of the MinHash estimate.

Edge cases: null text, or text without words, has an empty set and links with nothing; fewer
words than a shingle make one shingle of them all. Rows with a null id take no part in links
(component null, kept). Rows that share an id are one document, which has the links of all
its texts. An empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fmix, slices, small, span_hashes, tidy, utf8, word_spans

BANDS, ROWS, SKETCH_BITS = 32, 6, 512
STAR_ROUNDS = 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(off: np.ndarray, data: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct 64-bit shingle hashes."""
    for a, b in slices(off):
        own, at = _LOWER[data[off[a] : off[b]]], off[a : b + 1] - off[a]
        starts, stops = word_spans(at, own)
        words = span_hashes(own, starts, stops)
        first = np.searchsorted(starts, at)
        factors = fmix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
        joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for j in range(width):
            joined += words[j : j + len(joined)] * factors[j]
        joined = fmix(joined)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= width:
                yield np.unique(joined[lo : hi - width + 1])
            elif hi > lo:
                yield fmix((words[lo:hi] * factors[: hi - lo]).sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo))
            else:
                yield np.zeros(0, np.uint64)


def minhashes(shingles: np.ndarray, count: int) -> np.ndarray:
    seeds = fmix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    a, b = seeds[:count, None] | np.uint64(1), seeds[count:, None]
    least = None
    for i in range(0, len(shingles), 1024):
        got = (a * shingles[None, i : i + 1024] + b).min(axis=1)
        least = got if least is None else np.minimum(least, got)
    return least


def odd_sketch(values: np.ndarray, bits: int) -> np.ndarray:
    """bits / 64 signed words."""
    places = (fmix(values + fmix(np.arange(len(values), dtype=np.uint64))) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def most_different(threshold: float, samples: int, bits: int) -> int:
    """The XOR population count expected of two sketches at that similarity."""
    return int(bits / 2 * (1 - np.exp(-4 * samples * (1 - threshold) / bits)))


def mark_of(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingles."""
    spots = np.arange(len(shingles), dtype=np.uint64)
    return int(fmix(shingles + spots).sum(dtype=np.uint64).view(np.int64)), int(fmix(shingles ^ fmix(spots + np.uint64(7))).sum(dtype=np.uint64).view(np.int64))


def _signatures(width: int, bands: int, rows: int, bits: int):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sets, keys, sketches = [], [], [], []
            known: dict[bytes, tuple] = {}
            for s in shingle_sets(*utf8(batch.column(1)), width):
                n.append(len(s))
                if not len(s):
                    sets.append((None, None))
                    keys.append(None)
                    sketches.append(None)
                    continue
                mark = mark_of(s)
                got = known.get(mark)
                if got is None:
                    m = minhashes(s, bands * rows)
                    band = fmix((fmix(m.reshape(bands, rows)) * (fmix(np.arange(rows, dtype=np.uint64)) | np.uint64(1))).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
                    got = known[mark] = (band.view(np.int64), odd_sketch(m, bits))
                sets.append(mark)
                keys.append(got[0])
                sketches.append(got[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.int64()), pa.array(keys, schema.field(4).type), pa.array(sketches, schema.field(5).type)], schema=schema)

    return run


def _marked(width: int):
    """The rows of (id, body) with their sets' marks."""
    schema = pa.schema([("id", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("body", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [mark_of(x) for x in shingle_sets(*utf8(batch.column(1)), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)), batch.column(1).cast(pa.string())], schema=schema)

    return run


def _rare(width: int):
    """(shingle, id) of every shingle of the texts."""
    schema = pa.schema([("shingle", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            sets = list(shingle_sets(*utf8(batch.column(1)), width))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets or [np.zeros(0, np.uint64)]).view(np.int64)), pa.array(np.repeat(ids, [len(x) for x in sets]))], schema=schema)

    return run


def _meet(width: int):
    """Pairs (a, b, their texts) with the size of their sets' intersection."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("both", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            both, sets = np.zeros(len(a), np.int64), {}
            for start in range(0, len(a), 256):  # the sets of some pairs at a time
                rows = range(start, min(start + 256, len(a)))
                for ids, column in ((a, 2), (b, 3)):
                    new = {ids[i]: i for i in rows if ids[i] not in sets}
                    texts = batch.column(column).take(pa.array(list(new.values()), pa.int64()))
                    sets.update(zip(new, shingle_sets(*utf8(texts), width), strict=True))
                for i in rows:
                    both[i] = len(np.intersect1d(sets[a[i]], sets[b[i]], assume_unique=True))
                if len(sets) > 1024:
                    sets = {}
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both)], schema=schema)

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that isn't a root; root: the least node
    that it reaches. Each step sends all neighbours of a node, and the node, to the least of them;
    it is written to the shared folder. Ends when the edges are stars."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "star")
    while True:
        several = edges.groupBy("u").count().filter("count > 1").select("u")
        if not several.unionAll(edges.join(edges.select(F.col("v").alias("w")).distinct(), F.col("u") == F.col("w"), "left_semi").select("u")).take(1):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
        sent = both.join(least, F.col("u") == F.col("k")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = cut(sent.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "star")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS, margin: float = 0.15) -> DataFrame:
    """One row per input row: <id>, n_shingles, component_id, kept."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
    signed = narrow.mapInArrow(tidy(_signatures(width, bands, rows, bits)), "id long, n long, set_a long, set_b long, keys array<long>, sketch array<long>")
    signed = cut(signed.withColumn("row", F.monotonically_increasing_id()), "near-signatures")
    usable = signed.filter("n > 0 AND id IS NOT NULL")
    # a class is named by its least row, as one id may have several texts; doc and of are its least id's
    classes = cut(usable.groupBy("set_a", "set_b").agg(F.min("row").alias("id"), F.min(F.struct("id", "n", "keys", "sketch")).alias("x")).select("set_a", "set_b", "id", F.col("x.id").alias("doc"), "x.n", "x.keys", "x.sketch"), "near-classes")
    posts = classes.select("id", F.explode("keys").alias("bucket"))
    shared = cut(posts.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select(F.col("bucket").alias("shared"), "size"), "near-buckets")
    found = cut(posts.join(shared, F.col("bucket") == F.col("shared")).select("bucket", "id", "size"), "near-posts")
    # a text that shares large buckets with many is the best leader of its group
    central = cut(found.groupBy("id").agg(F.sum("size").alias("weight")), "near-central")
    members = cut(found.select("bucket", "id").join(central.withColumnRenamed("id", "c_id"), F.col("id") == F.col("c_id")).select("bucket", "id", F.col("id").alias("root"), "weight"), "near-members")
    wanted = cut(classes.join(central.select(F.col("id").alias("need")), F.col("id") == F.col("need")).select("need", "doc", F.col("set_a").alias("wa"), F.col("set_b").alias("wb")), "near-wanted")
    # texts are picked by their documents' ids, and then by their sets, as one id may have several texts
    read = narrow.join(small(wanted.select("doc").distinct()), F.col("id") == F.col("doc")).select("id", "body").mapInArrow(tidy(_marked(width)), "id long, set_a long, set_b long, body string")
    texts = cut(read.join(small(wanted), (F.col("id") == F.col("doc")) & (F.col("set_a") == F.col("wa")) & (F.col("set_b") == F.col("wb"))).groupBy(F.col("need").alias("id")).agg(F.min("body").alias("body")), "near-texts")
    single = texts.mapInArrow(tidy(_rare(width)), "shingle long, id long").groupBy("shingle").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("c")).filter("c = 1")
    alone = single.groupBy(F.col("id").alias("s_id")).agg(F.count(F.lit(1)).alias("alone"))
    meta = cut(central.select("id").join(classes.select(F.col("id").alias("k_id"), "n", "sketch"), F.col("id") == F.col("k_id")).join(alone, F.col("id") == F.col("s_id"), "left").select(F.col("id").alias("key"), "n", "sketch", F.coalesce("alone", F.lit(0)).alias("alone")), "near-meta")
    allowed = most_different(percent / 100 - margin, bands * rows, bits)
    differ: Column = sum((F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(bits // 64)), F.lit(0))
    side = lambda c: meta.select(*[F.col(x).alias(f"{c}_{x}") for x in meta.columns])

    def meet(pairs: DataFrame) -> DataFrame:
        """(a, b, both, a_n, b_n) of the pairs, counted on their full sets."""
        first = texts.select(F.col("id").alias("b_id"), F.col("body").alias("b_body"))
        second = texts.select(F.col("id").alias("a_id"), F.col("body").alias("a_body"))
        full = pairs.join(first, F.col("b") == F.col("b_id")).join(second, F.col("a") == F.col("a_id")).select("a", "b", "a_body", "b_body")
        got = cut(full.mapInArrow(tidy(_meet(width)), "a long, b long, both long"), "near-met")
        return got.join(side("a"), F.col("a") == F.col("a_key")).join(side("b"), F.col("b") == F.col("b_key"))

    linked = 100 * F.col("both") >= percent * (F.col("a_n") + F.col("b_n") - F.col("both"))
    links, stars, away = None, 0, None
    while True:
        order = F.struct((-F.col("weight")).alias("w"), "id", "root") if not stars else F.struct(F.xxhash64(F.lit(stars), "id").alias("w"), "id", "root")
        state = members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(order).alias("leader"))
        open_ = cut(state.filter("lo <> hi").select(F.col("bucket").alias("open"), F.col("leader.id").alias("leader"), F.col("leader.root").alias("leader_root")), "near-open")
        if not open_.take(1):
            break
        live = members.join(open_, F.col("bucket") == F.col("open"))
        pairs = live.filter("root <> leader_root").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
        near = pairs.join(side("b"), F.col("b") == F.col("b_key")).join(side("a"), F.col("a") == F.col("a_key"))
        pairs = near.filter((100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & (differ <= allowed)).select("a", "b")
        pairs = cut(pairs, "near-pairs")
        met = meet(pairs)
        if not stars:  # how far each text is from its buckets' leaders, in shingles
            away = cut(met.select("a", "b", (F.col("a_n") + F.col("b_n") - 2 * F.col("both")).alias("away")), "near-away").unionAll(pairs.select(F.col("b").alias("a"), "b", F.lit(0).cast("long")).distinct())
            hubs = open_.select(F.col("open").alias("h_bucket"), F.col("leader").alias("hub"))
        new = cut(met.filter(linked).select("a", "b"), "near-links")
        links = new if links is None else links.unionAll(new)
        gained, tested = new.count(), pairs.count()
        if gained:
            by_root = members.select("id", "root").distinct()
            ends = new.join(by_root.toDF("ia", "ra"), F.col("a") == F.col("ia")).join(by_root.toDF("ib", "rb"), F.col("b") == F.col("ib"))
            members = _relabel(members, components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b"))))
        stars += 1
        if tested and gained * 20 >= tested and stars < STAR_ROUNDS:
            continue
        # all pairs of a bucket that still lie in different components, if their bounds allow a link:
        # two sets differ by at least what each differs from the leader, less twice what both can
        # share of that, and a shingle that no other text has is never shared
        mixed = members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select(F.col("bucket").alias("open"))
        rest = members.join(mixed, F.col("bucket") == F.col("open")).join(hubs, F.col("bucket") == F.col("h_bucket")).join(away.toDF("w_id", "w_hub", "away"), (F.col("id") == F.col("w_id")) & (F.col("hub") == F.col("w_hub")), "left")
        rest = cut(rest.join(meta, F.col("id") == F.col("key")).select("bucket", "id", "root", "n", "sketch", "alone", "away"), "near-rest")
        one, two = (rest.select(*[F.col(x).alias(f"{c}_{x}") for x in rest.columns]) for c in "ab")
        apart = F.col("a_away") + F.col("b_away") - 2 * F.least(F.col("a_away") - F.col("a_alone"), F.col("b_away") - F.col("b_alone"))
        most = F.least(F.col("a_n") - F.col("a_alone"), F.col("b_n") - F.col("b_alone"))
        may = (100 * most >= percent * (F.col("a_n") + F.col("b_n") - most)) & F.coalesce((100 + percent) * apart <= (100 - percent) * (F.col("a_n") + F.col("b_n")), F.lit(True))
        cross = one.join(two, (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_id") > F.col("b_id")) & (F.col("a_root") != F.col("b_root")) & may & (differ <= allowed))
        last = meet(cut(cross.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct(), "near-pairs"))
        links = links.unionAll(cut(last.filter(linked).select("a", "b"), "near-links"))
        break
    # rows that share an id are one document: their classes are linked too
    several = cut(usable.groupBy("id").agg(F.min(F.struct("set_a", "set_b")).alias("lo"), F.max(F.struct("set_a", "set_b")).alias("hi")).filter("lo <> hi").select(F.col("id").alias("of")), "near-several")
    members_of = usable.join(small(several), F.col("id") == F.col("of")).select("of", F.col("set_a").alias("wa"), F.col("set_b").alias("wb")).distinct()
    classes_of = cut(members_of.join(classes, (F.col("set_a") == F.col("wa")) & (F.col("set_b") == F.col("wb"))).select("of", "id"), "near-one-id")
    least = classes_of.groupBy(F.col("of").alias("one")).agg(F.min("id").alias("b"))
    same = classes_of.join(least, F.col("of") == F.col("one")).filter("id <> b").select(F.col("id").alias("a"), "b")
    merged = cut(components(same if links is None else links.unionAll(same)), "near-components")
    reached = cut(merged.unionAll(merged.select(F.col("root").alias("node"), "root")).distinct(), "near-reached")
    # the least document of each component of several classes
    firsts = reached.join(classes.select("id", "doc"), F.col("node") == F.col("id")).groupBy(F.col("root").alias("of_root")).agg(F.min("doc").alias("component"))
    named = cut(reached.join(firsts, F.col("root") == F.col("of_root")).select("node", "component"), "near-named")
    labels = classes.join(small(named), F.col("id") == F.col("node"), "left").select(F.col("set_a").alias("la"), F.col("set_b").alias("lb"), F.coalesce("component", "doc").alias("component"))
    labels = cut(labels, "near-labels")
    out = signed.join(labels, (F.col("set_a") == F.col("la")) & (F.col("set_b") == F.col("lb")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _relabel(members: DataFrame, roots: DataFrame) -> DataFrame:
    new = roots.toDF("node", "new_root")
    return cut(members.join(small(new), F.col("root") == F.col("node"), "left").select("bucket", "id", F.coalesce("new_root", "root").alias("root"), "weight"), "near-members")
