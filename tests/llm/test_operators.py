"""The ten operators on small fixtures: against brute force, and with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from leafmill.llm import bpe, common, exact_dedup, langid, line_dedup, mixing, near_dedup, passages, pii, token_files, topk, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, body string, n long, sha string, key string, root long"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def docs(spark, texts, sources=None, langs=None, ids=None):
    rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "a", None, 7, "x", 7, "x", "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


LINES = ["alpha beta gamma delta one", "epsilon zeta eta theta two", "iota kappa lambda mu three", "nu xi omicron pi four", "rho sigma tau upsilon five"]
ODD = [None, "", " ", "A b", "a B", "É", "é", "word " * 30_000, "x", "x", "one two three four five six", None, "\n".join(LINES), "\n".join(["own line here", *LINES]), "tail 's'safe   \n\n z"]


def test_empty_tables(spark):
    none = docs(spark, ["x"]).filter("false")
    for got in (exact_dedup.exact_dedup(none), near_dedup.near_dedup(none), line_dedup.line_dedup(none), mixing.mix(none), langid.language_id(none), bpe.bpe(none, RANKS, P.PATTERN), pii.pseudonymise(none, "k"), token_files.count_tokens(token_files.write_token_files(none, RANKS, P.PATTERN))):
        assert got.count() == 0
    assert warc.read_warc(warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
    assert topk.topk(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_rice_codes():
    rng = np.random.default_rng(0)
    for n, top in ((1, 2**64), (1000, 2**64), (500, 1000)):
        v = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        assert (exact_dedup.rice_decode(exact_dedup.rice_encode(v, 0), 0) == v).all()
    assert len(exact_dedup.rice_decode(exact_dedup.rice_encode(v[:0], 0), 0)) == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_exact(spark, parts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = collections.defaultdict(list)
    for i, t in enumerate(ODD):
        by[(t or "").translate(low)].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs(spark, ODD).repartition(parts)).collect()}
    for t, ids in by.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
    some = exact_dedup.exact_dedup(docs(spark, ["a", "a", "b"], ids=[None, 3, None])).collect()
    assert sorted((r.keep_id or -1, r.kept) for r in some) == [(-1, False), (3, False), (3, True)]


def test_warc(spark):
    pages = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "y" * 100_000), (5, "u", "y" * 100_000), (None, "u", "x")]
    index = warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit(1)))
    got = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_warc(index).collect())
    d = warc.base32_sha1
    assert got == [(0, "response", None, 1, d(b"x")), (1, "revisit", 2, 1, d(b"x")), (2, "response", None, 1, d(b"x")), (3, "revisit", 4, 0, d(b"")), (4, "response", None, 0, d(b"")), (5, "response", None, 100_000, d(b"y" * 100_000)), (5, "response", None, 100_000, d(b"y" * 100_000))]
    picked = warc.read_warc(index.filter("page_id = 5"))
    assert [len(r.payload) for r in picked.collect()] == [100_000, 100_000]


def encoder():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_pretokens():
    import regex

    rx, rng = regex.compile(P.PATTERN), random.Random(3)
    for _ in range(3000):
        texts = ["".join(rng.choice("ab'’stremvld  \n\t\xa0　\x1c\x85 1²é世👋!?._") for _ in range(rng.randint(1, 14))) for _ in range(3)]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        at = bpe.pretokens(codes, np.cumsum([len(t) for t in texts])).tolist()
        full = "".join(texts)
        assert [full[a:b] for a, b in zip(at, [*at[1:], len(full)], strict=True)] == [w for t in texts for w in rx.findall(t)]


def test_bpe_and_token_files(spark):
    enc = encoder()
    want = {i: enc.encode_ordinary(t or "") for i, t in enumerate(ODD)}
    for r in bpe.bpe(docs(spark, ODD).repartition(3), RANKS, P.PATTERN, keep_ids=True).collect():
        raw = np.array(want[r.doc_id], "<u4").tobytes()
        assert (r.ids, r.n_tokens, r.ids_sha256) == (want[r.doc_id], len(want[r.doc_id]), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()
    files = token_files.write_token_files(docs(spark, ODD).repartition(2), RANKS, P.PATTERN)
    order = {(r.path, i): d for r in files.collect() for i, d in enumerate(r.doc_ids)}
    for size in (64, 1 << 20):  # documents cross many small blocks
        got = token_files.count_tokens(files.select("path", "bytes"), block_bytes=size).collect()
        assert {order[r.path, r.ordinal]: r.n_tokens for r in got} == {i: len(x) for i, x in want.items()}


def test_unterminated_token_file(spark, tmp_path):
    (tmp_path / "a.tokens").write_bytes(np.array([1, 2, 50256, 50256, 3], "<u2").tobytes())
    got = token_files.count_tokens(token_files.token_files(spark, str(tmp_path)), block_bytes=4).orderBy("ordinal").collect()
    assert [(r.n_tokens, r.terminated) for r in got] == [(2, True), (0, True), (1, False)]


def brute_near(texts, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_near(spark):
    rng = random.Random(5)
    texts = list(ODD)
    for _ in range(6):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(30, 150))]
        for _ in range(rng.choice([2, 5, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(docs(spark, texts).repartition(3)).collect()}
    assert got == brute_near(texts)


def test_near_at_80(spark):
    """Pairs between 0.80 and 0.85 are linked at 80 and not at 85."""
    base = [f"w{i}" for i in range(104)]
    texts = [" ".join(base), " ".join([*base[:30], "x", "y", *base[32:70], "z", *base[71:]]), " ".join([*base[:50], "q", *base[51:]])]
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(docs(spark, texts), percent=percent).collect()}
        assert got == brute_near(texts, percent)
    assert brute_near(texts, 80) != brute_near(texts, 85)


def test_near_of_rows_that_share_an_id(spark):
    """Such rows are one document, with the links of all its texts, in whatever order."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    for rows in ([(3, b), (2, b), (2, a), (1, a)], [(5, a), (5, b), (5, c), (6, c), (4, b), (9, None), (None, a)], [(1, a), (1, a), (2, b), (2, ""), (3, b)]):
        got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(2)).collect()}
        groups = collections.defaultdict(set)
        for i, c_, _ in got:
            groups[c_].add(i)
        want = {1: {1, 2, 3}} if rows[0][0] in (1, 3) and len(rows) == 4 else {4: {4, 5, 6}, 9: {9}, None: {None}} if len(rows) == 7 else {1: {1}, 2: {2, 3}}
        assert groups == want and all(k == (i is None or i == c_) for i, c_, k in got)


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_topk(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).round(3).tolist()) for i in range(300)] + [(7, [0.0] * 12), (400, None), (None, [1.0] * 12), (401, [float("nan")] * 12), (402, [None] * 12), (403, [1e6] * 12), (404, [1.0])]
    got = topk.topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("score", F.lit(1)), F.col("vec_id") % 50 == 0).collect()
    fine = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, v in fine:
        if q % 50 == 0:
            want = sorted(((int(v @ w), i) for i, w in fine if i != q and len(w) == len(v)), key=lambda x: (-x[0], x[1]))[:5]
            assert [(r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == want


def brute_topk(rows, k):
    """For each query row, its list of (score, vec_id) over all other rows."""
    out = []
    for j, (q, v) in enumerate(rows):
        if q % 50 == 0:
            every = sorted(((sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)), i) for n, (i, w) in enumerate(rows) if n != j and len(w) == len(v)), key=lambda x: (-x[0], x[1]))
            out.append((q, every[:k]))
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 3e7, 1.6e8])
def test_topk_of_rows_that_share_an_id(spark, scale):
    """Each is a query and a candidate of its own; ties; integers beyond floats and beyond 64 bits; rounds."""
    rng = np.random.default_rng(4)
    rows = [(int(i), (rng.integers(-9, 9, 4) * scale / 256).tolist()) for i in rng.integers(0, 120, 90)] + [(50, [scale / 64, 0.0, 0.0, 0.0]), (50, [scale / 64, 0.0, 0.0, 0.0]), (50, [scale / 128, 0.0, 0.0, 0.0]), (100, [0.0] * 4), (100, [0.0] * 4), (150, [])]
    if scale > 1e8:  # bounds of sums beyond 64 bits, sums within
        rows = [(i, [v[0], 0.0, 0.0, 0.0] if v else v) for i, v in rows]
    for size in (topk.QUERY_BYTES, 100):
        got = collections.defaultdict(list)
        for r in topk.topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 50 == 0, query_bytes=size).collect():
            got[r.query_id, r.rank].append((r.score, r.vec_id))
        want = collections.defaultdict(list)
        for q, best in brute_topk(rows, 5):
            for n, x in enumerate(best):
                want[q, n + 1].append(x)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_topk_split():
    """Non-essential postings are read only for vectors still competitive, and a threshold cuts the next shard's reads."""
    rng = np.random.default_rng(3)
    cells = np.rint(rng.normal(size=(4000, 64)) * np.geomspace(4000, 1, 64)).astype(np.int64)
    block = topk.Block(cells[:8], 5)
    block.meet(np.arange(2000), cells[:2000])
    assert block.read == 8 * 64 * 2000
    block.meet(np.arange(2000, 4000), cells[2000:])
    assert block.read < 8 * 64 * 2000 + 0.7 * 8 * 64 * 2000
    for q, (ids, scores) in zip(cells[:8], block.best):
        every = cells @ q
        first = np.lexsort((np.arange(4000), -every))[:5]
        assert ids.tolist() == first.tolist() and scores.tolist() == every[first].tolist()
    low, high = np.array([-5, -1, 0]), np.array([5, 1, 0])
    assert [topk.essential(low, high, f) for f in (-np.inf, -4, -3, 5, 7)] == [3, 2, 1, 1, 0]


def test_mixing(spark):
    rng = random.Random(4)
    sources = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in range(3000)]
    d = docs(spark, [" ".join(["w"] * rng.randint(0, 60)) for _ in range(2999)] + [None], sources).repartition(5)
    got = mixing.mix(d).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(d.repartition(2)).collect()), key=str)
    total, by = 0, collections.defaultdict(lambda: [0, 0, 0])
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == r.size * len(r.positions)
        by[r.source][0] += r.size
        by[r.source][1] += r.taken
        by[r.source][2] = r.target
        total += r.size
    for size, taken, target in by.values():
        assert target <= 2 * size and abs(taken - target) <= 60
    assert abs(sum(t for _, _, t in by.values()) - 1.5 * total) < 1


def test_mixed_rows_that_share_an_id(spark):
    """Each such row is taken for itself, so the words taken are those that mix() states."""
    rng = random.Random(2)
    texts = [" ".join(["w"] * rng.randint(0, 9)) + f" t{i}" for i in range(60)]
    ids = [rng.choice([1, 2, None]) if i % 4 == 0 else 100 + i for i in range(60)]
    d = docs(spark, texts, [rng.choice("ab") for _ in range(60)], ids=ids).repartition(3)
    taken = collections.Counter(r.text for r in mixing.mixed(d).collect())
    assert max(taken.values()) <= 2 and mixing.mixed(d).columns == d.columns
    sizes = sum(len(t.split()) for t in texts)
    assert abs(sum(n * len(t.split()) for t, n in taken.items()) - 1.5 * sizes) <= 20
    assert mixing.mixed(d.filter("false")).count() == 0


LANGS = {"en": ["the", "with", "thing"], "fr": ["les", "avec", "eaux"], "de": ["der", "mit", "schön"]}


def labelled(n, seed=6):
    rng = random.Random(seed)
    langs = [rng.choice(list(LANGS)) for _ in range(n)]
    return [" ".join(rng.choice(LANGS[k]) for _ in range(40)) for k in langs], langs


def brute_score(model, text):
    """(language, score) of a text, n-gram by n-gram, without numpy's arrays."""
    M = 1 << 32
    codes = [0] + [ord(c) if c.isalpha() else 0 for c in text.lower()] + [0, 0]
    sums, n = [0] * len(model["langs"]), 0
    for a, b, c in zip(codes, codes[1:] + [0], codes[2:] + [0, 0]):
        for h, ok in (
            (a * 0x9E3779B1, a),
            (a * 0x85EBCA6B + b * 0xC2B2AE35 + 0x27D4EB2F, a or b),
            (a * 0x165667B1 + b * 0x9E3779B1 + c * 0x85EBCA77 + 0x2C1B3C6D, b),
        ):
            if ok:
                h %= M
                h = (h ^ (h >> 15)) * 0x2C1B3C6D % M
                n += 1
                sums = [s + int(model["logits"][k][h >> 17]) for k, s in enumerate(sums)]
    if not n:
        return "und", 0.0
    z = [(s / (langid.UNIT * n) + float(model["bias"][k])) / model["heat"] for k, s in enumerate(sums)]
    e = [math.exp(x - max(z)) for x in z]
    return model["langs"][e.index(max(e))], max(e) / sum(e)


def test_language(spark):
    texts, langs = labelled(300)
    d = docs(spark, [*texts, None, "", "123 !?"], langs=[*langs, "en", "en", None])
    got = {r.doc_id: r for r in langid.language_id(d).collect()}
    held = [i for i in range(300) if got[i].held_out]
    assert sum(got[i].lang_pred == langs[i] for i in held) >= 0.99 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (300, 301, 302))
    assert {r.lang_pred for r in langid.language_id(docs(spark, ["a", "b"], langs=[None, None])).collect()} == {"und"}
    assert {(r.lang_pred, r.score) for r in langid.language_id(docs(spark, ["a", "b"])).collect()} == {("en", 1.0)}
    kept = {r.doc_id for r in langid.reject(d).collect()}
    assert not kept & {300, 301, 302} and len(kept) >= 299


def test_language_of_a_text_alone(spark):
    """What stands beside a text in a batch changes nothing, whatever the order; both equal the brute-force scorer."""
    texts, langs = labelled(60)
    model = langid.train([langid.bag(t) for t in texts], langs)
    odd = [*texts[:12], "123 !?", "the thing", "", "ß", "12", "a", " ", "é1è", "İstanbul ΣΑΣ", "x" * 3, "the " * 400_000]
    want = [brute_score(model, t[:4000]) for t in odd]
    rng = random.Random(1)
    for parts in (1, 2, 7):
        rows = rng.sample(range(len(odd)), len(odd))
        d = docs(spark, [odd[i] for i in rows], ids=rows).repartition(parts)
        got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_id(d, model=model).collect()}
        assert [got[i][0] for i in range(len(odd))] == [w[0] for w in want]
        assert all(abs(got[i][1] - w[1]) < 1e-9 for i, w in enumerate(want[:-1]))
        if parts > 1:
            assert got == last
        last = got
    n, sums = langid.sums_of(model, [odd[-1]])
    assert got[len(odd) - 1] == (lambda x: (x[0][0], x[1][0]))(langid.judge(model, n, sums))  # in pieces as at once


def test_language_of_rows_that_share_an_id(spark):
    """A rejected text takes no other with it."""
    texts, langs = labelled(90)
    d = docs(spark, [*texts, "123", texts[0], "456", texts[1]], langs=[*langs, None, None, None, None], ids=[*range(90), 7, 7, None, None])
    kept = [(r.doc_id, r.text) for r in langid.reject(d).collect()]
    assert (7, texts[0]) in kept and (None, texts[1]) in kept and len(kept) == 92 and not {"123", "456"} & {t for _, t in kept}


def test_language_calibration(spark):
    """Enough rows are held back that the share of rejected ones is at least a row."""
    d = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "the with thing").otherwise("der mit schön").alias("text"), (F.col("id") % 2).cast("string").alias("lang"))
    assert langid.fit(d, F.lit(False))["checks"] * langid.REJECT_SHARE >= 1


def test_many_languages(spark):
    d = spark.range(1005).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"), F.concat(F.lit("l"), F.col("id")).alias("lang"))
    assert len(langid.fit(d, F.lit(False))["langs"]) == 1005


def brute_gone(texts, single=None):
    """The numbers of the lines that go from each text: a line goes if it lies in a run of 3 lines or 50 words that agrees,
    line by line, with an earlier place; with single, also if it has so many words, stands in several texts, and not
    here first."""
    rows = [[(k, b.strip()) for k, b in enumerate((t or "").encode().split(b"\n")) if b.strip()] for t in texts]
    places, met = collections.defaultdict(list), collections.defaultdict(list)
    for i, row in enumerate(rows):
        for a, (_, line) in enumerate(row):
            for f, fa in places[line]:
                met[i, f, a - fa].append(a)
            places[line].append((i, a))
    gone = [set() for _ in texts]
    for (i, *_), ats in met.items():
        for _, run in itertools.groupby(enumerate(ats), lambda x: x[1] - x[0]):
            lines = [rows[i][a] for _, a in run]
            if len(lines) >= 3 or sum(len(line.split()) for _, line in lines) >= 50:
                gone[i] |= {k for k, _ in lines}
    for line, found in places.items():
        if single and len(line.split()) >= single and len({i for i, _ in found}) > 1:
            for i, a in found[1:]:
                gone[i].add(rows[i][a][0])
    return gone


def brute_lines(texts):
    """(text, lines removed) of each text."""
    return [(None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g), len(g)) for t, g in zip(texts, brute_gone(texts), strict=True)]


def test_lines_among_other_neighbours(spark):
    """Runs are found though each of their lines has its first place elsewhere, and so are long lines alone."""
    run = [f"shared line {i}" for i in range(3)]
    long = " ".join(f"w{i}" for i in range(60))
    texts = [f"{line}\nown {i}" for i, line in enumerate(run)] + ["\n".join(["a", *run, "b"]), "\n".join(["c", *run, "d"]), f"x\n{long}\ny", f"z\n{long}\ny\nq", f"{long}\nt"]
    got = [r.text for r in line_dedup.line_dedup(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == [*texts[:4], "c\nd", texts[5], "z\nq", "t"] == [t for t, _ in brute_lines(texts)]


def test_lines_of_rows_that_share_an_id(spark):
    """They are documents of their own: of equal rows one stays whole."""
    x = "\n".join(LINES)
    for parts in (1, 4):
        d = docs(spark, [x, x, x, "own\n" + x, "y", None], ids=[1, 2, 2, 2, 3, None]).repartition(parts)
        got = sorted((r.doc_id or 0, "-" if r.text is None else r.text) for r in line_dedup.line_dedup(d).collect())
        assert got == [(0, "-"), (1, x), (2, ""), (2, ""), (2, "own"), (3, "y")]
        d = docs(spark, [x, x, x], ids=[2, 2, None]).repartition(parts)
        assert sorted((r.doc_id or 0, r.text) for r in line_dedup.line_dedup(d, passage_words=10, single_words=2).collect()) == [(0, x), (2, ""), (2, x)]


def test_windows():
    """Against the definition; a fingerprint is the rightmost of the least hashes."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        first = np.append(0, np.cumsum(rng.integers(0, 8, 3)))
        words, hashes = rng.choice([1, 2, 30, 60], first[-1]), rng.integers(0, 4, first[-1]).astype(np.uint64)
        want = set()
        for lo, hi in zip(first[:-1], first[1:]):
            ok = {(a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1) if b - a >= 3 or words[a:b].sum() >= 50}
            want |= {(a, min(b for x, b in ok if x == a)) for a, _ in ok} | {(max(a for a, x in ok if x == b), b) for _, b in ok}
        begins, ends = line_dedup.windows(words, first, 3, 50)
        assert set(zip(begins.tolist(), ends.tolist())) == want
        at, _ = line_dedup.fingerprints(hashes, begins, ends)
        assert [max(i for i in range(a, b) if hashes[i] == hashes[a:b].min()) for a, b in zip(begins, ends)] == at.tolist()


def test_span_hashes():
    """Equal spans hash alike wherever they stand, also those longer than one pass."""
    rng = np.random.default_rng(5)
    long = rng.integers(0, 9, common.SLICE_BYTES * 2 + 77).astype(np.uint8)
    data = np.concatenate([[1, 2, 3], long, [7], [1, 2, 3], long, [1, 2, 4]]).astype(np.uint8)
    n = len(long)
    starts = np.array([0, 3, n + 3, n + 4, n + 7, 2 * n + 7])
    h = common.span_hashes(data, starts, np.append(starts[1:], len(data)))
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4
    text = b" a\t\tbc \n" * 200_000 + b"x" * (common.SLICE_BYTES + 5) + b" y"
    off = np.array([0, 9, 9, 11, len(text)])
    starts, stops = common.word_spans(off, np.frombuffer(text, np.uint8))
    want = [(m.start() + a, m.end() + a) for a, b in zip(off[:-1], off[1:]) for m in re.finditer(rb"[^ \t-\r]+", text[a:b])]
    assert list(zip(starts.tolist(), stops.tolist())) == want


def test_lines(spark):
    rng = random.Random(8)
    pool = [f"line {i} {rng.random()}" for i in range(60)] + [""]
    texts = ["\n".join(rng.choice(pool) if rng.random() < 0.3 else pool[(s + k) % 61] for k in range(rng.randint(0, 15))) for s in (rng.randrange(61) for _ in range(150))] + ODD
    got = {r.doc_id: (r.text, r["__removed"]) for r in line_dedup.line_dedup(docs(spark, texts).repartition(3)).collect()}
    for i, want in enumerate(brute_lines(texts)):
        assert got[i] == want


def brute_passages(texts, size, single=None):
    """(words left, lines changed) of each text: besides brute_gone, a word goes if it lies in a window of words that
    stands earlier, and not over itself; windows that the line rules took as a whole are no places."""
    first, out = {}, []
    for t, gone in zip(texts, brute_gone(texts, single), strict=True):
        words = [(x, k) for k, line in enumerate((t or "").split("\n")) for x in re.findall(r"[^\x09-\x0d ]+", line)]
        stay = [k not in gone for _, k in words]
        own = list(stay)
        for p in range(len(words) - size + 1):
            if any(own[p : p + size]):
                f = first.setdefault(tuple(x for x, _ in words[p : p + size]), (len(out), p))
                if f[0] < len(out) or f[1] + size <= p:
                    stay[p : p + size] = [False] * size
        out.append(([x for (x, _), s in zip(words, stay, strict=True) if s], len({k for (_, k), s in zip(words, stay, strict=True) if not s})))
    return out


def test_passages_inside_lines(spark):
    """Passages that begin or end inside a line go, at their later places, and the words around them stay."""
    run = [f"p{i}" for i in range(60)]
    flat = " ".join(run)
    texts = [f"a {flat} b", f"c  {flat} d\n\ne", "\n".join(["x " + " ".join(run[:20]), " ".join(run[20:45]), " ".join(run[45:]) + " y "]), " ".join(run[:49]) + " q", " ".join(run[5:55]), f"{flat}\r\nz"]
    got = [(r.text, r["__removed"]) for r in line_dedup.line_dedup(docs(spark, texts), passage_words=50).orderBy("doc_id").collect()]
    assert got == [(texts[0], 0), ("c  d\n\ne", 1), ("x\ny ", 3), (texts[3], 0), ("", 1), ("z", 1)]


def test_single_lines(spark):
    """A line of 5 words in several documents stays at its first place; shorter ones, and those of one document, stay."""
    texts = ["own a\n one two three four five \nshort line here", "one two three four five", "short line here\none two three four five\nx\none two three four five", "again and again and again\ny\nagain and again and again", None]
    got = [(r.text, r["__removed"]) for r in line_dedup.line_dedup(docs(spark, texts), single_words=5).orderBy("doc_id").collect()]
    assert got == [(texts[0], 0), ("", 1), ("short line here\nx", 2), (texts[3], 0), (None, 0)]


def test_passages(spark):
    rng = random.Random(9)
    pool = [f"é{i}" for i in range(400)]
    texts = list(ODD)
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 4)):
            s = rng.randrange(400)
            words += (pool + pool)[s : s + rng.randint(1, 40)] + [f"own{rng.random()}"] * rng.randint(0, 2)
        texts.append("".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\n\n"]) for w in words))
    want = brute_passages(texts, 12)
    got = {r.doc_id: (r.text, r["__removed"]) for r in line_dedup.line_dedup(docs(spark, texts).repartition(3), passage_words=12).collect()}
    assert [(re.findall(r"[^\x09-\x0d ]+", got[i][0] or ""), got[i][1]) for i in range(len(texts))] == want and sum(n > 0 for _, n in want) > 50


def test_lines_of_blank_texts():
    """Texts without a word, alone in a task, have no lines."""
    numbers, hashes, words, first = line_dedup.lines_of(np.array([0, 0, 2, 3]), np.frombuffer(b"\n  ", np.uint8))
    assert len(numbers) == len(hashes) == len(words) == 0 and first.tolist() == [0, 0, 0, 0]


def test_passage_marks():
    """Windows in a row are one entry for their mark, so half a window that stands twice brings only windows that it is
    least in; a loop of words has several entries."""
    rng = np.random.default_rng(4)
    size, hashes = 12, rng.integers(1, 1 << 60, 500).astype(np.uint64)
    hashes[300:330] = 7
    parts = passages._window(hashes, 6, passages._pair)
    ok = np.arange(500) % 97 > 10
    at, n, marks = passages.winnow(hashes, ok, size)
    covered = np.concatenate([np.arange(a, a + k) for a, k in zip(at, n, strict=True)])
    assert covered.tolist() == np.flatnonzero(ok[: 500 - size + 1]).tolist() and n.max() <= 7
    assert all(parts[w : w + 7].min() == m for a, k, m in zip(at, n, marks, strict=True) for w in range(a, a + k))
    assert (marks == parts[310]).sum() > 1


def test_passages_of_a_batch():
    """What is left of several texts at once; adjacent and equal ranges are one."""
    texts = [b"a b\n\nc d e\n", b"", b"x\ny z\n", b"p q r"]
    off, data = np.append(0, np.cumsum([len(t) for t in texts])), np.frombuffer(b"".join(texts), np.uint8)
    ranges = passages.merged(np.array([0, 3, 3, 3, 4]), np.array([3 * passages.SPAN + 1, 2 * passages.SPAN + 1, 3 * passages.SPAN + 1, 2 * passages.SPAN + 1]))
    los, his, of = ranges
    assert (los[:1].tolist(), his[:1].tolist(), of[:2].tolist()) == ([2], [4], [0, 1])
    starts, lengths, first, changed = passages.left_of(off, data, np.array([0, 0, 0, 1, 1]), np.array([0]), of, los, his)
    left = [b"".join(t[a - 1 : a - 1 + k] for a, k in zip(starts[i:j], lengths[i:j], strict=True)) for t, i, j in zip(texts, first[:-1], first[1:], strict=True)]
    assert left == [b"a b\n\ne\n", b"", b"y z\n", b"p q"] and changed.tolist() == [1, 0, 1, 1]


def luhn(d):
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def test_pii(spark):
    rows = [None, "", "none here: a=b", "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112", "2021-03-04 03/04/2021 04.03.2021 2021-02-30", "mail Bob.35@x.example.com, +1 (449) 555-5046", "10.0.0.1 999.1.1.1 10.0.0.1", "DE89 3704 0044 0532 0130 00", "123-45-6789"]
    got = [r.text for r in pii.pseudonymise(docs(spark, rows), "k").orderBy("doc_id").collect()]
    assert got[:3] == rows[:3]
    cards = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", got[3])
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and luhn(re.sub(r"\D", "", cards[0])) and got[3].endswith("4111111111111112") and "4111 1111" not in got[3]
    a, b, c, d = got[4].split()
    assert d == "2021-02-30" and a != "2021-03-04" and b == f"{a[5:7]}/{a[8:]}/{a[:4]}" and c == f"{a[8:]}.{a[5:7]}.{a[:4]}"
    assert re.fullmatch(r"mail [A-Z][a-z]{2}\.\d{2}@x\.example\.com, \+1 \(\d{3}\) \d{3}-\d{4}", got[5]) and "Bob" not in got[5] and "5046" not in got[5]
    x, y, z = got[6].split()
    assert x == z != "10.0.0.1" and y == "999.1.1.1"
    iban = got[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban[4:] != "370400440532013000"


def test_pii_beside_other_numbers(spark):
    """A card beside an expiry, a CVV or other numbers, and an IBAN before a word or number, get what they get alone."""
    card, iban = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"
    frames = [(card, f) for f in ("%s", "%s 12/26", "12 %s", "123 4567 %s 12/26", "%s 123", "%s %s 999", "%s-123")] + [("4111111111111111", "%s 123"), ("4111111111111111", "%s")]
    frames += [(iban, f) for f in ("%s", "%s EUR", "%s 12", "%s 4111", "%s %s")]
    rest = [f"{card} 2026-12-31", f"{card} 10.0.0.1", "4111111111111111 123-45-6789"]
    got = [r.text for r in pii.pseudonymise(docs(spark, [f % ((x,) * f.count("%s")) for x, f in frames] + rest), "k").orderBy("doc_id").collect()]
    alone = {x: y for (x, f), y in zip(frames, got, strict=False) if f == "%s"}
    assert got[: len(frames)] == [f % ((alone[x],) * f.count("%s")) for x, f in frames] and all(x != y for x, y in alone.items())
    assert all(a.split()[-1] != b.split()[-1] and a[:16] != b[:16] for a, b in zip(got[len(frames) :], rest, strict=True))


def test_feistel_permutes(spark):
    for n in (1, 2, 3):
        d = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("d")).select(pii.feistel(F.col("d"), "k", F.lit("s")).alias("p"))
        assert d.distinct().count() == 10**n and d.filter(F.length("p") != n).count() == 0


def test_pipeline(spark):
    """Each stage's output against a brute-force version on that stage's input."""
    import corpus_pipeline
    import duckdb

    from leafmill.llm.registry import ORACLE_SQL

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    inputs, columns = [d.orderBy("doc_id").collect()], d.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, d, sf)
        assert after.columns == columns
        d = spark.createDataFrame(after.collect(), d.schema)
        inputs.append(sorted(d.collect(), key=lambda r: r.doc_id))
    read, told, cleaned, near, mixed = inputs
    # language ID: what goes is und or scored below the calibrated threshold, by a scorer without numpy's arrays
    docs_in = spark.createDataFrame(read)
    model = langid.fit(docs_in, langid.held_out_of("doc_id"))
    scored = {r.doc_id: brute_score(model, r.text or "") for r in read}
    assert [r.doc_id for r in told] == [r.doc_id for r in read if scored[r.doc_id][0] != "und" and scored[r.doc_id][1] >= model["threshold"] - 1e-9] and len(told) > 0.95 * len(read)
    # line dedup, by runs, passages and single lines; documents that it has emptied go
    want = {r.doc_id: (words, n) for r, (words, n) in zip(told, brute_passages([r.text for r in told], 50, 5), strict=True)}
    want = {i: words for i, (words, n) in want.items() if not n or words}
    assert {r.doc_id: re.findall(r"[^\x09-\x0d ]+", r.text) for r in cleaned} == want and any(r.text.split() != want.get(r.doc_id) for r in told)
    # near-dedup: the least id of each group stays
    roots = brute_near([r.text for r in cleaned], 80)
    assert [r.doc_id for r in near] == [r.doc_id for i, r in enumerate(cleaned) if roots[i][1] == i]
    # mixing: each document as often as the SQL takes it
    import pandas as pd

    documents = pd.DataFrame([r.asDict() for r in near])  # noqa: F841
    taken = {i: t // n for i, n, t in duckdb.sql(f"SELECT doc_id, size, taken FROM ({ORACLE_SQL['op9_mixing']}) WHERE taken > 0").fetchall()}
    assert collections.Counter(r.doc_id for r in mixed) == taken
    enc = encoder()
    want = sorted((r.doc_id, len(enc.encode_ordinary(r.text))) for r in mixed)
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf).collect()) == want
