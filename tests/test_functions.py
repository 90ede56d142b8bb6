import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions import packing
from leafmill.functions import text as T
from leafmill.operators import chunks as K


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (T.tokens, "abcd", 1), (T.tokens, "abcde", 2), (T.tokens, None, 0), (T.tokens, "漢字漢字漢字", 2), (T.tokens, "👋👋a", 2),
        (T.rejoin_hyphenated, "a Long-\nTerm plan", "a Long-Term plan"), (T.rejoin_hyphenated, "pumper-\nnickel", "pumpernickel"), (T.rejoin_hyphenated, "x-\r\ny é-\nè", "xy é-\nè"), (T.rejoin_hyphenated, "a-\nb-\nc", "ab-\nc"),
        (T.rejoin_hyphenated, "aaaaaaaaaaaaaaaaaaaa-\neeeeeeeeeeeeeeeeeeee", "aaaaaaaaaaaaaaaaaaaa-eeeeeeeeeeeeeeeeeeee"),
        (T.punctuation, "a—b–c“d’", "a--b-c\"d'"), (T.ligatures, "\ufb00\ufb01\ufb02\ufb03\ufb04\ufb05\ufb06p", "fffiflffifflststp"), (T.whitespace, " a \t b\r\nc​ ", "a b\nc"),
        (T.nfc, "é", "é"), (T.strip_html, "<p>a &lt;b&gt;&nbsp;c</p>", "a <b> c"), (T.strip_html, None, ""), (T.heading_level, "x<H3 class=a>", 3), (T.heading_level, "<p>", 0),
        (T.sentences, "Cut as in FIG. 7.3 shown. Bones by fig. 8.1 follow. End.", ["Cut as in Fig. 7.3 shown.", "Bones by Fig. 8.1 follow.", "End."]),
        (T.sentences, "One. Two.", ["One.", "Two."]), (T.sentences, "One.​Two.", ["One.​Two."]), (T.sentences, "", []),
        (T.figure_references, "Figs. 7.8-7.10 and 9.1", ["Fig. 7.10", "Fig. 7.8", "Fig. 7.9", "Fig. 9.1"]), (T.figure_references, "Figs. 6.1, 5.2, and 5.9", ["Fig. 5.2", "Fig. 5.9", "Fig. 6.1"]),
        (T.figure_id, "x FIGURE 2.10 y", "Fig. 2.10"), (T.inline_image, "![a](b.png) ![c](d.png)", "b.png"), (T.caption_text, "FIGURE 4.1. A cut.", "A cut."),
        (T.abbreviations, "A., artery; V., vein; A., aorta", {"V.": "vein", "A.": "aorta"}), (T.snippet, "a" * 101, "a" * 100 + "..."), (T.snippet, "👋" * 51, "👋" * 50 + "..."), (T.snippet, "b " + "👋" * 50, "b..."), (T.snippet, "👋" * 50, "👋" * 50),
        (T.is_decomposed, "e\u0301", True), (T.is_decomposed, "\u00e9", False), (T.combining_marks, "e\u0301a\u0300\u20d0", 3), (T.nfc, "e\u0301 \u2126 \uf900", "\u00e9 \u03a9 \u8c48"),
        (T.is_abbreviation_line, "Ant., anterior; Post., back.", True), (T.is_abbreviation_line, "V., the long vein", True), (T.is_abbreviation_line, "A cut of it.", False), (T.is_abbreviation_line, "A., " + "so " * 50_000 + "X", False),
        (T.abbreviation_block, "A cut.\n\nA., one; B., two.\n \nC., three.", "A., one; B., two.\nC., three."), (T.abbreviation_block, "A., one.\nA cut.", None), (T.caption_abbreviations, "A cut.\nA., one; B., two two.", {"A.": "one", "B.": "two two"}), (T.caption_abbreviations, "A cut", {}),
        (T.rejoin_hyphenated, "a" * 100_000, "a" * 100_000), (T.rejoin_hyphenated, "b" * 100_000 + "-\nc", "b" * 100_000 + "c"), (T.sentences, "1" * 100_000, ["1" * 100_000]), (T.sentences, "v 1.2.3.4 x", ["v 1.2.3.4 x"]), (T.whitespace, "a\t b  c \td", "a b c d"),
        (T.sentences, "\ue010\ue100 stays. Five No. 5.", ["\ue010\ue100 stays.", "Five No. 5."]),
    ],
)
def test_column(spark, f, value, expected):
    assert one(spark, value, f) == expected


def test_sentences_in_both_forms(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "No.", "ms.", ". ", "! ", "B", " ", "3.14", " ", "é", "\n", "👋", "etc. "]) for _ in range(30)) for _ in range(300)]
    got = [r.s for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").orderBy("i").select(T.sentences(F.col("x")).alias("s")).collect()]
    assert got == [packing.split_sentences(t) for t in texts]


def test_split_block_keeps_words_and_budget():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["word ", "Long-er ", "End. ", "\n\n"]) for _ in range(rng.randint(1, 400)))
        parts = packing.split_block(text, 10, 60)
        assert " ".join(parts).split() == text.split()
        assert len(parts) == 1 or all(packing.count(p) <= 60 for p in parts)


def test_accumulate():
    assert packing.accumulate(["a" * 40, "b" * 4, "c" * 4], 3, 1) == [["a" * 40], ["b" * 4, "c" * 4]]


def test_fold():
    row = lambda n: {"content": "x" * 4 * n, "breadcrumb_text": "", "token_count": n, "n_blocks": 1, "content_with_context": ""}
    assert [r["n_blocks"] for r in K.fold([row(100), row(10), row(500)])] == [2, 1]
    assert [r["n_blocks"] for r in K.fold([row(10), row(100)])] == [2]
    assert [r["n_blocks"] for r in K.fold([row(10), row(510)])] == [1, 1]


def test_merge_in_batches(spark):
    """Islands that go on in another batch are folded as one."""
    rows = [(d, 0, b, 0, f"s{b // 37}", False, "[C]", f"d{d} text {b}", f"[C]\n\nd{d} text {b}", 5 + b % 3 * 60) for d in range(3) for b in range(200)]
    chunks = spark.createDataFrame(rows, "document_id int, page int, block int, part int, section_id string, is_figure_caption boolean, breadcrumb_text string, content string, content_with_context string, token_count long")
    want = sorted((r["document_id"], r["block"], r["content"], r["n_blocks"]) for d in range(3) for s in range(6) for r in K.fold([dict(zip(chunks.columns, x)) | {"n_blocks": 1} for x in rows if x[0] == d and x[2] // 37 == s]))
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = sorted((r.document_id, r.block, r.content, r.n_blocks) for r in K.merge_small(chunks.repartition(3)).collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want


def test_gates_on_nothing(spark):
    import __spark_entry__ as e  # noqa: F401
    from leafmill.plans import queries as Q

    chunks = Q.conversation_chunks(spark, "/root/testdata/sf0.001").filter("false")
    source = chunks.withColumn("block_type", F.lit("text"))
    got = {r.gate: r.passed for r in K.gates(chunks, source).collect()}
    assert not got["content_coverage"] and not got["min_token_check"] and got["max_token_limit"]


def test_json_tree(spark, tmp_path):
    from leafmill.sources import readers

    (tmp_path / "a.json").write_text('{"block_type":"Document","children":[{"block_type":"X","children":null},{"block_type":"Page","bbox":[0,0,1,1],"children":[{"id":"/1","block_type":"SectionHeader","html":"<h2>T</h2>","children":[{"id":"/2","block_type":"Odd","html":"a &amp; b","section_hierarchy":{"10":"j","2":"b"},"children":null}]}]}]}')
    rows = readers.content_blocks(readers.blocks(readers.json_documents(spark, str(tmp_path)))).orderBy("ord").collect()
    assert [(r.page, r.id, r.block_type, r.level, r.content, r.parent_hierarchy, r.section_id) for r in rows] == [(1, "/1", "section_header", 2, "T", [], ""), (1, "/2", "text", 0, "a & b", ["b", "j"], "j")]


def test_push(spark):
    from leafmill.sources import sinks

    got = sinks.push(spark.range(120).coalesce(1), lambda rows: [None if r["id"] % 10 == 0 else 1 for r in rows]).first()
    assert (got.added, got.duplicates) == (108, 12)


def test_json_tree_beyond_the_recursion_limit(spark, tmp_path):
    """Deep trees are read whole; fields that are missing raise."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    from leafmill.sources import readers

    node = '"children":null'
    for i in range(150):
        node = f'"children":[{{"id":"/{i}","block_type":"Text","html":"x",{node}}}]'
    (tmp_path / "a.json").write_text('{"block_type":"Document","children":[{"block_type":"Page","bbox":[],%s}]}' % node)
    assert readers.blocks(readers.json_documents(spark, str(tmp_path))).count() == 150
    for bad in ('{"children":[]}', '{"block_type":"Document"}', '{"block_type":"Document","children":[{"block_type":"Page","children":[]}]}', '{"block_type":"Document","children":[{"block_type":"Page","bbox":[],"children":[{"id":"/1","block_type":"Text"}]}]}', "{"):
        (tmp_path / "a.json").write_text(bad)
        with pytest.raises((PySparkException, Py4JJavaError)):
            readers.blocks(readers.json_documents(spark, str(tmp_path))).collect()


def test_markdown(spark, tmp_path):
    from leafmill.sources import readers

    (tmp_path / "a.md").write_text("lost\n{0}------\n# One\n\ntext\n{3}--\n  \n{4}----\nlast\n")
    got = readers.markdown_pages(spark, str(tmp_path / "a.md")).orderBy("page_number").collect()
    assert [(r.page_number, r.content) for r in got] == [(0, "# One\n\ntext"), (3, ""), (4, "last")]
    assert readers.markdown_lines(spark, str(tmp_path / "a.md")) == 10


def test_stream_of_files(spark, tmp_path):
    from leafmill.streaming import files

    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(source)
    for n in (10, 25):
        files.run_on_new(spark, source, "id long", lambda d: d.withColumn("twice", F.col("id") * 2), sink, str(tmp_path / "at")).awaitTermination()
        assert spark.read.parquet(sink).count() == n
        spark.range(15).write.mode("append").parquet(source)
