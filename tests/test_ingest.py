"""The ingest program, end to end on a small export."""

import json

import pytest
from pyspark.errors import PySparkException

from leafmill.plans import chunk, ingest
from leafmill.sources import readers


def block(i, kind, html, children=None):
    return {"id": f"/page/0/{kind}/{i}", "block_type": kind, "html": html, "bbox": [0, 0, 1, 1], "section_hierarchy": {"1": "/page/0/SectionHeader/0"}, "children": children}


@pytest.fixture
def export(tmp_path):
    page = {"block_type": "Page", "bbox": [0, 0, 1, 1], "children": [block(0, "SectionHeader", "<h1>A &amp; B</h1>"), block(1, "Text", "<p>See Fig. 4.1, the eﬃcient one.</p>"), block(2, "Caption", "<p>FIGURE 4.1. A cut.</p>")]}
    (tmp_path / "a.json").write_text(json.dumps({"block_type": "Document", "children": [page]}))
    (tmp_path / "images").mkdir()
    (tmp_path / "images/_page_1.jpg").write_bytes(b"x")
    return tmp_path


def test_ingest(spark, export):
    out = str(export / "out")
    got = ingest.ingest(spark, str(export / "a.json"), str(export / "images"), out, "A Title: one")
    assert {r.gate: r.status for r in got.collect()} == dict.fromkeys(("parse_rate", "ligature_count", "figure_coverage"), "pass")
    figure = readers.figure_map(spark, f"{out}/figure_map").collect()
    assert [(r.document_id, r.figure_id, r.image_file, r.status) for r in figure] == [("a-title-one", "Fig. 4.1", "_page_1.jpg", "mapped")]
    text = "\n".join(r.value for r in spark.read.text(f"{out}/content", wholetext=True).collect())
    assert text.startswith("# A Title: one\n\n**Author:** Unknown\n\n---\n\n# A & B\n\nSee Fig. 4.1, the efficient one.")
    whole = json.loads(spark.read.text(f"{out}/document").first().value)
    assert (whole["id"], whole["title"], whole["author"], len(whole["pages"])) == ("a-title-one", "A Title: one", "Unknown", 1)
    assert whole["source_files"] == {"json": str(export / "a.json"), "markdown": "", "image_dir": str(export / "images")}
    entry = whole["figure_map"]["Fig. 4.1"]
    assert (entry["image_path"], entry["referencing_blocks"], entry["page_number"], entry["abbreviations"]) == (str(export / "images/_page_1.jpg"), ["/page/0/Text/1"], 0, {})
    meta = whole["metadata"]
    assert [meta[k] for k in ("pipeline_version", "source_json_lines", "source_markdown_lines", "total_images", "parse_rate", "ligature_count", "figure_coverage")] == ["1.0.0", 3, 0, 1, 100.0, 0, 100.0]
    summary = json.loads(spark.read.text(f"{out}/figure_map").first().value)["summary"]
    assert summary["by_status"] == {"mapped": 1, "no-image-in-caption": 0, "unresolved": 0}
    with pytest.raises(FileExistsError):
        ingest.ingest(spark, str(export / "a.json"), str(export / "images"), out, "A Title: one")
    again = ingest.validate(spark, out)
    assert {r.status for r in again.collect()} == {"pass"}
    assert ingest.main(["--out", out, "--validate-only"]) == 0


def test_ingest_by_config(spark, export):
    (export / "a.md").write_text("{0}----\n# A\nx")
    out = export / "by-config"
    (export / "c.json").write_text(json.dumps({"sources": {"json": str(export / "a.json"), "markdown": str(export / "a.md"), "imageDir": str(export / "images")}, "output": {"baseDir": str(out), "document": "d", "figureMap": "f", "content": "c"}, "document": {"id": "own-id", "title": "T", "author": "N. N."}}))
    assert ingest.main(["--config", str(export / "c.json")]) == 0
    whole = json.loads(spark.read.text(f"{out}/document").first().value)
    assert (whole["id"], whole["author"], whole["metadata"]["source_markdown_lines"]) == ("own-id", "N. N.", 3)


def test_block_that_breaks_its_contract(spark, export):
    page = {"block_type": "Page", "bbox": [0, 0, 1, 1], "children": [block(0, "Text", "x") | {"id": "odd"}]}
    (export / "a.json").write_text(json.dumps({"block_type": "Document", "children": [page]}))
    with pytest.raises(PySparkException, match="a block breaks its contract: id"):
        ingest.ingest(spark, str(export / "a.json"), str(export / "images"), str(export / "out"), "T")


def test_ingest_without_images(spark, export):
    (export / "images/_page_1.jpg").unlink()
    assert ingest.main(["--json", str(export / "a.json"), "--images", str(export / "images"), "--out", str(export / "o"), "--title", "T", "--force"]) == 1


def test_image_names(spark, tmp_path):
    for name in ("_page_10.png", "_page_2.jpeg", "x.gif", "note.txt", ".hidden.png"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.image_file for r in readers.images(spark, str(tmp_path)).orderBy("position").collect()] == ["x.gif", "_page_2.jpeg", "_page_10.png"]
    assert readers.images(spark, str(tmp_path / "none")).count() == 0


def test_block_fields(spark, tmp_path):
    kinds = ["FigureCaption", "Equation", "Formula", "TextInlineMath", "ListGroup", "Odd"]
    nodes = [block(i, k, "<p>Fig. 4.2, fig. 4.1 and Fig. 4.2</p>") | {"bbox": [1, 2, 3, 4] if i else [1]} for i, k in enumerate(kinds)]
    (tmp_path / "a.json").write_text(json.dumps({"block_type": "Document", "children": [{"block_type": "Page", "bbox": [], "children": nodes}]}))
    got = readers.content_blocks(readers.blocks(readers.json_documents(spark, str(tmp_path)))).orderBy("ord").collect()
    assert [r.block_type for r in got] == ["figure_caption", "inline_math", "inline_math", "inline_math", "text", "text"]
    assert tuple(got[0].bbox) == (0.0, 0.0, 0.0, 0.0) and tuple(got[1].bbox) == (1.0, 2.0, 3.0, 4.0)
    assert got[0].figure_references == ["Fig. 4.2", "Fig. 4.1"]


def test_chunk_program(spark, export):
    out = str(export / "out")
    ingest.ingest(spark, str(export / "a.json"), str(export / "images"), out, "A Title: one")
    # a chunk of 13 tokens before a caption of its section fails the gate of small chunks
    assert chunk.main(["--in", out, "--out", f"{out}/c"]) == 1
    rows = spark.read.parquet(f"{out}/c/chunks").orderBy("sequence_number").collect()
    assert rows[0].__fields__ == list(chunk.K.CHUNK)
    assert [(r.chunk_id, r.content, r.breadcrumb, r.page_numbers, r.source_block_ids, r.is_figure_caption, r.character_count) for r in rows] == [
        ("a-title-one-chunk-0000", "See Fig. 4.1, the efficient one.", ["A & B"], [1], ["/page/0/Text/1"], False, 32), ("a-title-one-chunk-0001", "FIGURE 4.1. A cut.", ["A & B"], [1], ["/page/0/Caption/2"], True, 18)]
    assert [[f.asDict() for f in r.figure_references] for r in rows] == [[{"figure_id": "Fig. 4.1", "image_path": f"{export}/images/_page_1.jpg", "caption_snippet": "A cut."}]] * 2
    index = json.loads(spark.read.text(f"{out}/c/chunk_index").first().value)
    ids = ["a-title-one-chunk-0000", "a-title-one-chunk-0001"]
    assert index == {"document_id": "a-title-one", "total_chunks": 2, "chunks_by_section": {"/page/0/SectionHeader/0": ids}, "chunks_by_page": {"1": ids}, "figure_to_chunks": {"Fig. 4.1": ids}}
    whole = json.loads(spark.read.text(f"{out}/c/chunks_json").first().value)
    assert [c["chunk_id"] for c in whole["chunks"]] == ids and whole["chunks"][0]["previous_chunk_id"] is None and whole["total_chunks"] == 2
    gates = {g.name: (g.status, g.value) for g in spark.read.json(f"{out}/c/validation").first().gates}
    assert gates["content_coverage"] == ("PASS", "100%") and gates["min_token_check"] == ("FAIL", "1") and len(gates) == 7
    page = "\n".join(r.value for r in spark.read.text(f"{out}/c/preview", wholetext=True).collect())
    assert page.index('id="a-title-one-chunk-0000"') < page.index('id="a-title-one-chunk-0001"') < page.index("<script>")
    with pytest.raises(FileExistsError):
        chunk.main(["--in", out, "--out", f"{out}/c"])
    # the written document gives the same chunks
    assert chunk.main(["--document", f"{out}/document", "--figure-map", f"{out}/figure_map", "--out", f"{out}/d"]) == 1
    assert spark.read.parquet(f"{out}/d/chunks").orderBy("sequence_number").collect() == rows


def test_chunk_contract(spark, export):
    (export / "images/_page_1.jpg").unlink()
    out = str(export / "out")
    ingest.ingest(spark, str(export / "a.json"), str(export / "images"), out, "A Title: one")
    with pytest.raises(ValueError, match="chunk-0000 .figure_references"):
        chunk.main(["--in", out, "--out", f"{out}/c"])
    assert chunk.existing(spark, f"{out}/c", chunk.OUTPUTS) == []
    assert chunk.main(["--in", out, "--out", f"{out}/c", "--lenient"]) == 1


def test_merged_chunks_unite_sources():
    row = lambda n, i, p: {"content": "x" * 4 * n, "breadcrumb_text": "", "token_count": n, "n_blocks": 1, "content_with_context": "", "character_count": 4 * n, "source_block_ids": [i], "page_numbers": [p], "figure_references": [i]}
    (got,) = chunk.K.fold([row(100, "a", 2), row(10, "b", 1), row(5, "a", 2)])
    assert (got["source_block_ids"], got["page_numbers"], got["figure_references"], got["character_count"]) == (["a", "b"], [1, 2], ["a"], 464)


def test_overlap_counts(spark):
    """The joining blank isn't counted; characters are those of the content."""
    text = "[Context: Document Root]\n\n"
    rows = spark.createDataFrame([(1, 0, i, 0, "s", c, False, text[:-2], text + c) for i, c in enumerate(("Abc.", "Next one."))], "document_id int, page int, block int, part int, section_id string, content string, is_figure_caption boolean, breadcrumb_text string, content_with_context string")
    got = chunk.K.overlap(rows).orderBy("block").collect()[1]
    assert (got.content, got.overlap_tokens, got.character_count) == ("Abc. Next one.", 1, 14)
