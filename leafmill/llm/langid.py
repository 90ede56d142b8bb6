"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text's features are the character 1- to 3-grams of its words (lower case, letters only, a
mark at both ends of a word), hashed to BUCKETS rows of an embedding table; their mean goes
through a softmax layer. Both are trained by stochastic gradient descent in numpy, on a sample of at most
PER_LANGUAGE labelled documents of each language, taken by hash from all of them. As the
model is linear after the mean, prediction uses the product of both tables: one row of
logits for each bucket.

Rejection is calibrated on a fifth of the sample, or on up to CHECK_ROWS rows taken besides it where there are
so many, so that REJECT_SHARE of them is at least a row; of each language one row at least trains, and where that
leaves no row to calibrate on, the training rows serve. A temperature is fitted to them, and the
threshold is the largest score up to 0.5 below which at most REJECT_SHARE of its correctly
classified documents lie. Texts without a letter are `und` and rejected.

A text is predicted alike alone and in any batch: it has marks of its own at both ends, and logits are whole numbers.

Edge cases: null or empty text is `und` with the score 0; no labelled row at all makes every
text `und`; one language alone is predicted with the score 1. Rows labelled `und` don't train, as `und` says that
nothing is predicted. Repeated rows are predicted
alike. A null id is not held out, and never sampled. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_process, pieces, shielded, small, tidy, utf8

BUCKETS, DIM, ORDERS = 1 << 15, 16, 3
PER_LANGUAGE, EPOCHS, RATE, TABLE_RATE, BATCH = 600, 8, 0.5, 20.0, 8
#: A logit of 1 as a whole number.
UNIT = 1 << 24
REJECT_SHARE, CHECK_ROWS = 0.001, 2000


def letters() -> np.ndarray:
    return per_process("langid-letters", lambda: np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def ngrams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: (bucket of each n-gram, where each text's begin and the last one's end). Each text has
    a mark of its own before it and after it, so what stands beside it in a batch changes nothing."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer(("".join(f" {t} " for t in low) + "  ").encode("utf-32-le", "replace"), np.uint32).copy()
    ends = np.cumsum([len(t) + 2 for t in low])
    codes[~letters()[codes]] = 0
    out = []
    n = len(codes) - 2
    a, b, c = (codes[i : n + i] for i in range(ORDERS))
    for h, ok in (
        (a * np.uint32(0x9E3779B1), a > 0),
        (a * np.uint32(0x85EBCA6B) + b * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F), (a > 0) | (b > 0)),
        (a * np.uint32(0x165667B1) + b * np.uint32(0x9E3779B1) + c * np.uint32(0x85EBCA77) + np.uint32(0x2C1B3C6D), b > 0),
    ):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts = np.append(0, np.cumsum(ok))
        out.append(((h >> np.uint32(17))[ok].astype(np.int32), np.append(0, counts[ends]) if len(low) else np.zeros(1, np.int64)))
    return out


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's n-grams and how many of them fall into each."""
    raw, counts = text.encode("utf-8", "replace"), np.zeros(BUCKETS, np.int64)
    for _, _, lo, hi in pieces(np.array([0, len(raw)]), raw):
        for buckets, _ in ngrams([raw[lo:hi].decode("utf-8", "replace")]):
            counts += np.bincount(buckets, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def train(samples: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 0, per_language: int = PER_LANGUAGE) -> dict:
    """The model: languages, logits by bucket, bias, temperature, threshold, and how many rows it was calibrated on.
    samples: the rows' bags."""
    names = sorted(set(langs))
    if not names:
        return {"langs": [], "logits": np.zeros((0, BUCKETS), np.int64), "bias": np.zeros(0), "heat": 1.0, "threshold": 0.0, "checks": 0}
    y = np.searchsorted(names, langs)
    rng = np.random.default_rng(seed)
    bags = [(at, (n / max(1, n.sum())).astype(np.float32)) for at, n in samples]
    order = rng.permutation(len(bags))
    spare = len(order) - len(names) * per_language * 4 // 5
    first = np.zeros(len(order), bool)  # of each language one row is for training in any case
    first[np.unique(y[order], return_index=True)[1]] = True
    held = order[~first][: max(len(order) // 5, min(CHECK_ROWS, spare))]
    use = np.setdiff1d(order, held)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        mixed = rng.permutation(use)
        for i in range(0, len(mixed), BATCH):
            batch = [j for j in mixed[i : i + BATCH] if len(bags[j][0])]
            if not batch:
                continue
            mean = np.array([bags[j][1] @ table[bags[j][0]] for j in batch])
            p = _softmax(mean @ layer + bias)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            back = p @ layer.T
            layer -= rate * (mean.T @ p)
            bias -= rate * p.sum(axis=0)
            for j, g in zip(batch, back, strict=True):  # buckets within a text are distinct
                table[bags[j][0]] -= rate * TABLE_RATE * bags[j][1][:, None] * g
    # fixed point: sums of whole numbers are exact, whatever the order and the batch
    logits = np.round((table @ layer).T * UNIT).astype(np.int64)
    bias = bias.astype(np.float64)
    checks = held if len(held) else use
    z = np.array([logits[:, samples[j][0]] @ samples[j][1] / (UNIT * max(1, samples[j][1].sum())) + bias for j in checks]).reshape(len(checks), len(names))
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(checks)), y[checks]] + 1e-12).mean()
    heat = min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)
    p = _softmax(z / heat)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[checks]])
    threshold = min(0.5, float(right[int(REJECT_SHARE * len(right))])) if len(right) else 0.0
    return {"langs": names, "logits": logits, "bias": bias, "heat": heat, "threshold": threshold, "checks": len(checks)}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sums_of(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text how many n-grams it has, and the sums of their logits."""
    k = len(model["langs"])
    n, sums = np.zeros(len(texts), np.int64), np.zeros((len(texts), k), np.int64)
    for buckets, at in ngrams(texts):
        own = np.diff(at)
        n += own
        some = np.flatnonzero(own)
        if len(some):
            for c in range(k):
                sums[some, c] += np.add.reduceat(model["logits"][c][buckets], at[some])
    return n, sums


def judge(model: dict, n: np.ndarray, sums: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language and score of each text, from sums_of."""
    if not model["langs"]:
        return ["und"] * len(n), np.zeros(len(n))
    p = _softmax((sums / (UNIT * np.maximum(n, 1))[:, None] + model["bias"]) / model["heat"])
    best, score = p.argmax(axis=1), p.max(axis=1)
    return [model["langs"][i] if x else "und" for i, x in zip(best, n, strict=True)], np.where(n > 0, np.clip(score, 0, 1), 0.0)


def fit(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict:
    """Trains on labelled rows that aren't held out: at most per_language of each language, and
    calibrates on others."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"), F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out.alias("held")).filter("lang IS NOT NULL AND id IS NOT NULL AND NOT held AND lang <> 'und'")
    sizes = cut(rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "langid-sizes")
    most = per_language + -(-CHECK_ROWS // max(1, sizes.count()))
    # a hash threshold thins each language before the exact limit, so no task gets a whole one
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    thin = rows.join(small(sizes), F.col("lang") == F.col("of")).filter(place * F.col("n") < F.lit(2.0 * most) * F.lit(1 << 30))
    first = Window.partitionBy("lang").orderBy("place", "id", "body")
    taken = thin.withColumn("place", place).withColumn("k", F.row_number().over(first)).filter(F.col("k") <= most).select("lang", "place", "id", "k", "body")
    # the driver gets bags, of at most BUCKETS entries each, and no text
    got = taken.mapInArrow(tidy(_bags), "lang string, place long, id string, k int, buckets array<int>, counts array<int>").toArrow()
    order = sorted(zip(*(got[c].to_pylist() for c in ("place", "id", "lang", "k")), range(got.num_rows), strict=True))
    read = lambda c, i: np.asarray(got[c][i].values, np.int32)
    return train([(read("buckets", x[-1]), read("counts", x[-1])) for x in order], [x[2] for x in order], per_language=per_language)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [bag(x or "") for x in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array([g[k].astype(np.int32) for g in got], pa.list_(pa.int32())) for k in (0, 1))], names=["lang", "place", "id", "k", "buckets", "counts"])


def _tag(model):
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(2))
            raw = data.tobytes()
            n, sums = np.zeros(len(off) - 1, np.int64), np.zeros((len(off) - 1, len(model.value["langs"])), np.int64)
            for a, b, lo, hi in pieces(off, raw):
                bounds = np.clip(off[a : b + 1], lo, hi)
                got = sums_of(model.value, [raw[bounds[i] : bounds[i + 1]].decode("utf-8", "replace") for i in range(b - a)])
                n[a:b] += got[0]
                sums[a:b] += got[1]
            langs, s = judge(model.value, n, sums)
            bad = [x == "und" or y < model.value["threshold"] for x, y in zip(langs, s, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(s, pa.float64()), pa.array(bad, pa.bool_()), batch.column(3)], schema=schema)

    return run


def held_out_of(id_col: str) -> Column:
    """Rows for testing: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: dict | None = None) -> DataFrame:
    """<id>, held_out, lang_pred, score, rejected, text_hash (XXH64) for each row; trains first unless given a model."""
    held = held_out_of(id_col)
    if model is None:
        model = fit(docs, held, id_col, text_col, lang_col)
    # fixed size: BUCKETS rows of one float for each language
    sent = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), held.alias("held"), F.col(f"`{text_col}`").cast("string").alias("body")).withColumn("text_hash", F.xxhash64("body"))
    return narrow.mapInArrow(tidy(_tag(sent)), "id long, held_out boolean, lang_pred string, score double, rejected boolean, text_hash long").withColumnRenamed("id", id_col)


def reject(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs without the rows that the classifier rejects; of rows that share an id, or have none, those with rejected texts."""
    docs, names = shielded(docs)
    id_col, text_col, lang_col = (names[c] for c in (id_col, text_col, lang_col))
    tagged = cut(language_id(docs, id_col, text_col, lang_col).filter("rejected").select(F.col(id_col).alias("__gone"), F.col("text_hash").alias("__hash")).distinct(), "langid-rejected")
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("__hash"))
    return docs.join(small(tagged), same, "left_anti").toDF(*names)
