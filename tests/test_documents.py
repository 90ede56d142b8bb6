"""Contracts, configuration, logs, row transforms, figure lookups."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from leafmill.log import Logger
from leafmill.operators import chunks as K
from leafmill.operators import contracts as R
from leafmill.operators import figures as G
from leafmill.operators import gates as V
from leafmill.operators import transforms as X
from leafmill.sources import config

CHUNK = {
    "chunk_id": "d-1-chunk-0000", "document_id": "d-1", "breadcrumb": ["A"], "breadcrumb_text": "[Context: A]", "content": "x", "content_with_context": "[Context: A]\n\nx", "page_numbers": [1], "source_block_ids": ["b"], "sequence_number": 0,
    "previous_chunk_id": None, "next_chunk_id": None, "parent_section_id": "", "figure_references": [("Fig. 1.2", "a.png", "c")], "token_count": 4, "character_count": 1, "overlap_tokens": 0, "is_figure_caption": False, "is_table": False, "contains_abbreviations": False,
}
TYPES = "chunk_id string, document_id string, breadcrumb array<string>, breadcrumb_text string, content string, content_with_context string, page_numbers array<int>, source_block_ids array<string>, sequence_number int, previous_chunk_id string, next_chunk_id string, parent_section_id string, figure_references array<struct<figure_id:string,image_path:string,caption_snippet:string>>, token_count int, character_count int, overlap_tokens int, is_figure_caption boolean, is_table boolean, contains_abbreviations boolean"


def test_chunk_contract(spark):
    wrong = [("chunk_id", "D-chunk-0000"), ("chunk_id", "d-chunk-00000"), ("document_id", ""), ("breadcrumb", []), ("breadcrumb_text", "A"), ("content", ""), ("content_with_context", None), ("page_numbers", [0]), ("page_numbers", []), ("source_block_ids", []), ("sequence_number", -1), ("parent_section_id", None), ("figure_references", [("Figure 1", "a.png", "c")]), ("figure_references", [("Fig. 1.2", "", "c")]), ("figure_references", [("Fig. 1.2", "a", "c" * 151)]), ("token_count", 601), ("token_count", 0), ("character_count", 0), ("overlap_tokens", -1), ("is_table", None)]
    rows = [tuple((CHUNK | {name: value}).values()) for name, value in [("content", "x"), *wrong]]
    got = [r.violations for r in K.violations(spark.createDataFrame(rows, TYPES).coalesce(1)).collect()]
    assert got == [[], *([name] for name, _ in wrong)]


def test_other_contracts(spark):
    good = {
        R.PAGE: spark.sql("SELECT 0 AS page_number, array(1) AS blocks"), R.SUMMARY: spark.sql("SELECT 2 AS total_figures, 1 AS mapped_count, 1 AS unmapped_count, 50.0 AS coverage_percentage"),
        R.METADATA: spark.sql("SELECT '2024-01-01T00:00:00.000Z' AS processed_at, '1' AS pipeline_version, 1 AS source_json_lines, 1 AS source_markdown_lines, 1 AS total_images, 0 AS ligature_count, 100.0 AS parse_rate, 90.0 AS figure_coverage"),
        R.GATE: spark.sql("SELECT 'a' AS name, '>1' AS threshold, 1.0 AS actual, 'pass' AS status"), R.REPORT: spark.sql("SELECT 'd' AS document_id, 'fail' AS overall_status, array(struct('g' AS gate, 'r' AS reason)) AS failures"),
        R.INDEX: spark.sql("SELECT 'd' AS document_id, 1 AS total_chunks, map('a', array('b')) AS chunks_by_section, map('a', array('b')) AS chunks_by_page, map('a', array('b')) AS figure_to_chunks"),
        R.OUTPUT: spark.sql("SELECT 'd' AS document_id, '2024-01-01T00:00:00Z' AS generated_at, 1 AS total_chunks, array(1) AS chunks"),
    }
    for rules, rows in good.items():
        assert R.violations(rows, rules).first().violations == []
        for name in rules():
            assert R.violations(rows.withColumn(name, F.lit(None).cast(rows.schema[name].dataType)), rules).first().violations == ([] if name == "failures" else [name])
            assert name in R.violations(rows.drop(name), rules).first().violations
    assert R.violations(good[R.GATE].withColumn("status", F.lit("odd")), R.GATE).first().violations == ["status"]
    assert R.require(good[R.GATE], R.GATE, "a gate").count() == 1
    with pytest.raises(PySparkException, match="a gate breaks its contract: status"):
        R.require(good[R.GATE].withColumn("status", F.lit("odd")), R.GATE, "a gate").collect()


def test_config(tmp_path):
    whole = {"sources": {"json": "a", "markdown": "b", "imageDir": "c"}, "output": {"baseDir": "o", "document": "d.json", "figureMap": "f", "content": "c"}, "document": {"id": "i", "title": "t", "author": "a"}}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(whole))
    got = config.load(str(path))
    assert config.output(got, "document") == "o/d.json" and config.output(got, "baseDir") == "o"
    path.write_text("{}")
    assert config.load(str(path)) is got  # read once
    config.load.cache_clear()
    for part, name in (("sources", "markdown"), ("output", "figureMap"), ("document", "author")):
        path.write_text(json.dumps(whole | {part: whole[part] | {name: ""}}))
        with pytest.raises(ValueError, match=name):
            config.load(str(path))
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.json"))


def test_log(capsys, monkeypatch):
    monkeypatch.setenv("LOG_LEVEL", "warn")
    Logger("a").info("unheard")
    Logger("a").child("b").error("bad", n=1)
    Logger(level="debug").debug("é")
    out, err = capsys.readouterr()
    (low,), (high,) = ([json.loads(x) for x in y.splitlines()] for y in (out, err))
    assert (low["level"], low["message"], "context" in low) == ("debug", "é", False)
    assert (high["level"], high["message"], high["context"]) == ("error", "[a:b] bad", {"n": 1}) and high["timestamp"].endswith("Z")


def test_transforms(spark):
    chunks = spark.createDataFrame([tuple((CHUNK | {"chunk_id": f"d-1-chunk-{i:04d}", "sequence_number": i}).values()) for i in range(3)], TYPES)
    ref = F.struct(F.lit("Fig. 9.9").alias("figure_id"), F.lit("z.png").alias("image_path"), F.lit("z").alias("caption_snippet"))
    got = X.with_overlap(X.with_figure_ref(X.as_figure_caption(chunks), ref), F.lit("before."), F.lit(2)).orderBy("sequence_number").collect()
    assert [r.figure_id for r in got[0].figure_references] == ["Fig. 1.2", "Fig. 9.9"] and got[0].is_figure_caption
    assert (got[0].content, got[0].content_with_context, got[0].overlap_tokens, got[0].token_count, got[0].character_count) == ("before. x", "[Context: A]\n\nbefore. x", 2, 6, 9)
    assert X.without_overlap(chunks.withColumn("overlap_tokens", F.lit(9))).first().overlap_tokens == 0 and X.with_token_count(chunks, F.lit(7)).first().token_count == 7
    assert X.with_figure_refs(chunks, F.array(ref)).first().figure_references[0].figure_id == "Fig. 9.9"
    assert [r.next_chunk_id for r in X.link_next(chunks).orderBy("sequence_number").collect()] == ["d-1-chunk-0001", "d-1-chunk-0002", None]
    linked = X.with_linking(chunks, F.lit("c"), F.lit(4), F.lit("p"), F.lit("n")).first()
    assert (linked.chunk_id, linked.sequence_number, linked.previous_chunk_id, linked.next_chunk_id) == ("c", 4, "p", "n")
    row = spark.sql("SELECT array(3, 1, 1) AS a, array(2, 1, 2) AS b").select(X.merge_unique(F.col("a"), F.col("b")), X.merge_sorted_unique(F.col("a"), F.col("b")), X.dedupe(F.col("a"))).first()
    assert list(row) == [[3, 1, 1, 2], [1, 1, 2, 3], [3, 1]]


def test_figure_entries(spark):
    rows = [(1, "figure_caption", "FIGURE 4.1. A cut.", "<p>FIGURE 4.1. A cut.</p>\nA., artery; V., vein."), (2, "text", "See Fig. 4.1 and Fig. 4.2.", ""), (3, "figure_caption", "FIGURE 4.2. Another.\nN., nerve.", None), (4, "text", "Fig. 4.1", "")]
    blocks = spark.createDataFrame([("d", b, b, f"b{b}", k, c, h) for b, k, c, h in rows], "document_id string, page int, block int, id string, block_type string, content string, raw_html string")
    images = spark.createDataFrame([("d", 1, "x.png")], "document_id string, position int, image_file string")
    got = {r.figure_id: r for r in G.entries(blocks, images, "img").collect()}
    a, b = got["Fig. 4.1"], got["Fig. 4.2"]
    assert (a.page_number, a.abbreviations, a.image_path, a.referencing_blocks, a.status) == (1, {"A.": "artery", "V.": "vein"}, "img/x.png", ["b2", "b4"], "mapped")
    assert (b.page_number, b.abbreviations, b.image_path, b.status) == (3, {"N.": "nerve"}, None, "no-image-in-caption")
    figures = G.figure_map(blocks, images)
    assert [r.figure_id for r in G.by_id(figures, spark.createDataFrame([("d", "Fig. 4.2"), ("d", "Fig. 9.9")], "document_id string, figure_id string")).collect()] == ["Fig. 4.2"]
    assert [r.figure_id for r in G.by_caption_block(figures, spark.createDataFrame([("d", "b1")], "document_id string, caption_block_id string")).collect()] == ["Fig. 4.1"]
    assert G.summary(figures).first().by_status.asDict() == {"mapped": 1, "no-image-in-caption": 1, "unresolved": 0}
    assert G.summary(figures.filter("false")).first().coverage_percentage == 0


def test_gate_lookup():
    assert V.gate("parse_rate")[1] == "Parse Rate"
    with pytest.raises(ValueError, match="there are parse_rate"):
        V.gate("odd")


def test_empty_breadcrumbs_fail_their_gate(spark):
    chunks = spark.createDataFrame([(1, 0, 0, 0, "s", "x", [], "[Context: Document Root]", 90, False, "c", 0)], "document_id int, page int, block int, part int, section_id string, content string, breadcrumb array<string>, breadcrumb_text string, token_count int, is_figure_caption boolean, chunk_id string, sequence_number int")
    source = chunks.withColumn("block_type", F.lit("text"))
    status = lambda c: {r.gate: r.passed for r in K.gates(c, source).collect()}["breadcrumb_coverage"]
    assert not status(chunks) and not status(chunks.drop("breadcrumb")) and status(chunks.withColumn("breadcrumb", F.array(F.lit("a"))))
