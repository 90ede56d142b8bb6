"""Byte-level BPE by a global shuffle of distinct words.

1. explode: tasks cut documents into blocks, split their texts into pre-tokens by array
   operations on code points, give each pre-token its position, and number the block's
   distinct words. The sequence of word numbers, by position, goes to the shared folder; each
   distinct word goes to the bucket of its hash, one packed row for each block and bucket.
2. encode: a bucket's task meets each distinct word of the whole corpus in one place, applies
   the merges once for it, and answers every block's row with that word's ids.
3. reassemble: a block's answers meet its saved sequence; positions take their words' ids.
   Decoding joins the token-byte table (one row for each id) to the ids.

A word that fills a third of the corpus is still one entry for each block, so no bucket is hot.
Buckets are streamed; a task holds ids of KNOWN_WORDS words at most and one row. A block holds its
bytes, its word numbers and its distinct words; code points only of a piece of it.

Edge cases: null text is empty; an empty text has no ids. A text larger than a block is a block
of its own, handled in pieces. Bytes that aren't UTF-8 count as U+FFFD. Repeated rows and null ids are separate documents. An empty table gives an empty
result. Extra columns are not read. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteWriter, cut, give_back, per_process, pieces, read_range, shared_dir, slices, span_hashes, tidy, utf8

#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
#: Parts of the vocabulary, at most: a block sends a row to each part that it has words of.
MOST_BUCKETS = 1024
#: Words whose ids a bucket's task keeps; a word that comes back after that is encoded again.
KNOWN_WORDS = 1_000_000
_DOCS = "kind string, block string, doc_ids binary, bucket int, payload binary"
_DOCS_SCHEMA = pa.schema([("kind", pa.string()), ("block", pa.string()), ("doc_ids", pa.binary()), ("bucket", pa.int32()), ("payload", pa.binary())])
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def char_classes() -> np.ndarray:
    """The class of each code point in the pre-token pattern."""
    import regex

    def make() -> np.ndarray:
        points = np.setdiff1d(np.arange(0x110000, dtype=np.uint32), np.arange(0xD800, 0xE000, dtype=np.uint32))
        every = points.tobytes().decode("utf-32-le")
        table = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[points[m.start()] : points[m.end() - 1] + 1] = kind
        return table

    return per_process("bpe-classes", make)


def pretokens(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in the code points of several texts; ends: where the texts end
    (none of them empty). The pattern of public_tokenizers, without a regex engine:
    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|spaces(?!non-space)|spaces"""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[codes]
    first = np.zeros(n + 1, bool)  # of a text
    first[0] = True
    first[ends] = True
    last = first[1:]
    start = first[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]  # of a run of one class
    space = kind == SPACE
    tail = np.zeros(n, bool)  # the last space before something else in the same text
    tail[:-1] = space[:-1] & ~space[1:]
    tail &= ~last
    start |= tail  # spaces(?!non-space) leaves the last one
    glued = tail & (codes == 32)
    start[1:] &= ~glued[:-1] | first[1:-1]  # ... and a blank joins what follows
    # contractions: an apostrophe that starts a pre-token and is alone before letters
    quote = np.flatnonzero((codes == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        padded = np.append(codes, [0, 0])
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        inside = ~first[np.minimum(quote + 2, n)]
        two = inside & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        hit = one | two
        size = np.where(one, 2, 3)[hit]
        q = quote[hit]
        start[q + 1] = False
        after = q + size
        start[after[after < n]] = True
    return np.flatnonzero(start)


def _valid(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts; what isn't UTF-8 in them becomes U+FFFD."""
    raw = data.tobytes()
    try:
        raw.decode()
    except UnicodeDecodeError:
        texts = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(off[:-1], off[1:], strict=True)]
        return np.cumsum([0, *map(len, texts)]).astype(np.int64), np.frombuffer(b"".join(texts), np.uint8)
    return off, data


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoder(path: str, pattern: str):
    import tiktoken

    return per_process(f"bpe-encoder {path}", lambda: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}))


def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: lengths and starts by id, and all bytes."""

    def make():
        ranks = load_ranks(path)
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        length = np.array([len(x) for x in by_id], np.int64)
        return length, np.cumsum(length) - length, np.frombuffer(b"".join(by_id), np.uint8)

    return per_process(f"bpe-bytes {path}", make)


def decode(ids: np.ndarray, path: str) -> np.ndarray:
    """The bytes of ids, as an array."""
    length, start, every = _token_bytes(path)
    n = length[ids]
    begin = np.cumsum(n) - n
    return every[np.arange(int(n.sum())) + np.repeat(start[ids] - begin, n)]


def pack(parts: list[np.ndarray]) -> bytes:
    """Arrays as one compressed value."""
    raw = [np.ascontiguousarray(p) for p in parts]
    head = np.array([len(raw), *[x for p in raw for x in ("BHIqQ".index(p.dtype.char if p.dtype.char not in "lL" else "q"), len(p))]], np.int64).tobytes()
    body = head + b"".join(p.tobytes() for p in raw)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    head, at, out = np.frombuffer(body, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, count in head.reshape(n, 2).tolist():
        dtype = np.dtype(["u1", "u2", "u4", "i8", "u8"][kind])
        out.append(np.frombuffer(body, dtype, count, at))
        at += count * dtype.itemsize
    return out


def _short(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint8 if not len(x) or x.max() < 256 else np.uint32)


def _gaps(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising numbers as low bytes and the rest of their gaps."""
    gaps = np.diff(numbers.astype(np.int64), prepend=0)
    return (gaps & 0xFF).astype(np.uint8), _short(gaps >> 8)


class _Words:
    """The distinct words of a block, numbered as they come, and the sequence of their numbers."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint32)  # sorted by hash
        self.count, self.place, self.length, self.seq = np.zeros(0, np.int64), [], [], []

    def add(self, hashes: np.ndarray, place: np.ndarray, length: np.ndarray) -> None:
        own, first, inverse, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.hashes, own)
        new = np.ones(len(own), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != own[inside]
        numbers = np.empty(len(own), np.uint32)
        numbers[~new] = self.numbers[at[~new]]
        numbers[new] = np.arange(len(self.count), len(self.count) + int(new.sum()), dtype=np.uint32)
        self.hashes, self.numbers = np.insert(self.hashes, at[new], own[new]), np.insert(self.numbers, at[new], numbers[new])
        self.count = np.append(self.count, np.zeros(int(new.sum()), np.int64))
        self.count[numbers] += count
        self.place.append(place[first[new]])
        self.length.append(length[first[new]])
        self.seq.append(numbers[inverse])


def _explode(folder: str, buckets: int):
    def block_rows(ids: list, off: np.ndarray, whole: bytes) -> Iterator[dict]:
        """One block: its sequence is saved, its words are dealt out by hash."""
        sizes = np.zeros(len(ids), np.int64)  # pre-tokens of each document
        words = _Words()
        data = np.frombuffer(whole, np.uint8)
        for a, b, lo, hi in pieces(off, whole):
            raw = whole[lo:hi]
            if not raw:
                continue
            codes = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            byte = np.append(np.flatnonzero((data[lo:hi] & 0xC0) != 0x80), len(raw)).astype(np.int32)  # a code point's first byte
            ends = np.searchsorted(byte[:-1], np.clip(off[a + 1 : b + 1], lo, hi) - lo)  # in code points
            starts = pretokens(codes, np.unique(ends[ends > 0]))
            sizes[a:b] += np.diff(np.searchsorted(starts, ends), prepend=0)
            stops = np.append(starts[1:], len(codes))
            words.add(span_hashes(codes, starts, stops), byte[starts].astype(np.int64) + lo, byte[stops] - byte[starts])
        digests = b"".join(hashlib.sha256(data[off[i] : off[i + 1]]).digest() for i in range(len(ids)))
        length, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (words.length, words.place))
        number = np.empty(len(words.count), np.uint32)  # frequent words get small numbers
        number[np.argsort(-words.count, kind="stable")] = np.arange(len(number), dtype=np.uint32)
        seq = number[np.concatenate(words.seq)] if words.seq else number
        wide = seq >= 0x8000
        low = np.where(wide, 0x8000 | (seq & 0x7FFF), seq).astype(np.uint16)
        saved = pack([(low & 0xFF).astype(np.uint8), (low >> 8).astype(np.uint8), (seq[wide] >> 15).astype(np.uint16), sizes])
        out = ByteWriter(folder, ".seq")
        out.write(saved)
        out.close()
        block = f"{out.uri.rpartition('/')[2]} {len(saved)}"
        yield {"kind": "docs", "block": block, "doc_ids": pack([np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], np.uint8), np.frombuffer(digests, np.uint8)]), "bucket": None, "payload": len(number).to_bytes(8, "little")}
        owner = np.empty(len(number), np.int64)
        owner[words.numbers] = (words.hashes % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((number, owner))  # numbers rise within a bucket, so their gaps are small
        bounds = np.searchsorted(owner[order], np.arange(buckets + 1))
        for k in range(buckets):
            own = order[bounds[k] : bounds[k + 1]]
            if len(own):
                n, p = length[own].astype(np.int64), place[own]
                begin = np.cumsum(n) - n
                chars = data[np.arange(int(n.sum())) + np.repeat(p - begin, n)]
                yield {"kind": "words", "block": block, "doc_ids": None, "bucket": k, "payload": pack([*_gaps(number[own]), _short(n), chars])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, parts, size = [], [], [], 0

        def flush():
            off = np.cumsum([0, *lengths]).astype(np.int64)
            whole = b"".join(parts)
            parts.clear()
            for row in block_rows(ids, off, whole):
                yield pa.RecordBatch.from_pylist([row], schema=_DOCS_SCHEMA)

        for batch in batches:
            keys, (off, data) = batch.column(0).to_pylist(), _valid(*utf8(batch.column(1)))
            for a, b in slices(off, BLOCK_BYTES):
                if parts and size + int(off[b] - off[a]) > BLOCK_BYTES:
                    yield from flush()
                    ids, lengths, size = [], [], 0
                ids += keys[a:b]
                lengths += np.diff(off[a : b + 1]).tolist()
                parts.append(data[off[a] : off[b]].tobytes())
                size += int(off[b] - off[a])
        if ids:
            yield from flush()

    return run


def _encode(path: str, pattern: str):
    schema = pa.schema([("block", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        encode = _encoder(path, pattern).encode_ordinary
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high, length, chars = unpack(payload)
                length = length.astype(np.int64)
                raw, end = chars.tobytes(), np.cumsum(length)
                found = []
                for a, b in zip((end - length).tolist(), end.tolist(), strict=True):
                    word = raw[a:b]
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        ids = known[word] = np.array(encode(word.decode("utf-8", "replace")), "<u4").tobytes()
                    found.append(ids)
                ids = np.frombuffer(b"".join(found), "<u4")
                answer = pack([low, high, _short(np.array([len(x) // 4 for x in found])), ids.astype(np.uint16) if not len(ids) or ids.max() < 65536 else ids])
                yield pa.RecordBatch.from_pylist([{"block": block, "payload": answer}], schema=schema)

    return run


def _reassemble(folder: str, path: str, keep_ids: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name, _, size = pdf["block"].iloc[0].rpartition(" ")
        saved = unpack(read_range(f"{folder}/{name}", 0, int(size)))
        seq = saved[0].astype(np.uint32) | (saved[1].astype(np.uint32) << 8)
        wide = np.flatnonzero(seq >= 0x8000)
        seq[wide] = (seq[wide] & 0x7FFF) | (saved[2].astype(np.uint32) << 15)
        of_docs = pdf["kind"] == "docs"
        doc = pdf[of_docs].iloc[0]
        words = int.from_bytes(doc["payload"], "little")
        length, start, parts, at = np.zeros(words, np.int64), np.zeros(words, np.int64), [], 0
        del wide
        for payload in pdf.loc[~of_docs, "payload"]:
            low, high, n, ids = unpack(payload)
            number = np.cumsum(low.astype(np.int64) | (high.astype(np.int64) << 8))
            n = n.astype(np.int64)
            length[number], start[number] = n, at + np.cumsum(n) - n
            parts.append(ids.astype(np.uint32))
            at += len(ids)
        every = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        keys, null, digests = unpack(doc["doc_ids"])
        out = {"id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        ends = np.cumsum(saved[3])
        a = 0
        while a < len(keys):  # some documents at a time
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 200_000, side="right")))
            lo = int(ends[a - 1]) if a else 0
            at_words = seq[lo : int(ends[b - 1])]
            n = length[at_words]
            begin = np.cumsum(n) - n
            total = int(n.sum())
            ids = every[np.arange(total) + np.repeat(start[at_words] - begin, n)]
            bounds = np.append(begin, total)[np.concatenate([[0], ends[a:b] - lo])]
            raw = decode(ids, path)
            token_ends = np.append(0, np.cumsum(_token_bytes(path)[0][ids]))[bounds]
            for i in range(b - a):
                own = ids[bounds[i] : bounds[i + 1]].astype("<u4")
                out["id"].append(None if null[a + i] else int(keys[a + i]))
                out["n_tokens"].append(len(own))
                out["ids_sha256"].append(hashlib.sha256(own.tobytes()).hexdigest())
                digest = hashlib.sha256(raw[token_ends[i] : token_ends[i + 1]]).digest()
                if digest != digests[32 * (a + i) : 32 * (a + i + 1)].tobytes():  # two words with one hash would show here
                    raise ValueError("the ids of a document don't decode to its text")
                out["decoded_sha256"].append(digest.hex())
                out["ids"].append(own.astype(np.int64) if keep_ids else None)
            a = b
        frame = pd.DataFrame(out)
        frame["id"] = frame["id"].astype("Int64")
        del seq, every, saved, parts
        give_back()
        return frame if keep_ids else frame.drop(columns="ids")

    return run


def bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, keep_ids: bool = False) -> DataFrame:
    """<id>, n_tokens, ids_sha256, decoded_sha256, and with keep_ids the ids themselves.

    ranks_path must be readable on the executors. buckets: parts of the vocabulary; by default
    two for each core of the cluster, 8 at least and MOST_BUCKETS at most."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "bpe-sequences")
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(8, 2 * spark.sparkContext.defaultParallelism))
    sent = cut(narrow.mapInArrow(tidy(_explode(folder, buckets)), _DOCS), "bpe-words")
    words = sent.filter("kind = 'words'").select("block", "payload", "bucket").repartitionById(buckets, "bucket").select("block", "payload")
    answers = words.mapInArrow(tidy(_encode(ranks_path, pattern)), "block string, payload binary")
    no_docs = F.lit(None).cast("binary").alias("doc_ids")
    met = sent.filter("kind = 'docs'").select("kind", "block", "doc_ids", "payload").unionAll(answers.select(F.lit("words").alias("kind"), "block", no_docs, "payload"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if keep_ids else "")
    return met.groupBy("block").applyInPandas(_reassemble(folder, ranks_path, keep_ids), schema).withColumnRenamed("id", id_col)
