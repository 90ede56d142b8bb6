"""Document gates, attached figures, saved figure maps, card reports."""

import pytest
from pyspark.errors import PySparkException

from leafmill.operators import cards as C
from leafmill.operators import figures as G
from leafmill.operators import gates as V
from leafmill.sources import readers


def test_gate_edges(spark):
    rows = [("a", 100.0, 0, 90.0), ("b", 99.996, 3, 90.1), ("c", None, None, None)]
    got = {(r.document_id, r.gate): r for r in V.evaluate(spark.createDataFrame(rows, "document_id string, parse_rate double, ligature_count long, figure_coverage double")).collect()}
    status = lambda d: [got[d, g].status for g in ("parse_rate", "ligature_count", "figure_coverage")]
    assert (status("a"), status("b"), status("c")) == (["pass", "pass", "fail"], ["fail", "fail", "pass"], ["fail"] * 3)
    assert got["b", "parse_rate"].actual == 100.0 and got["b", "ligature_count"].details == "Found 3 ligature characters"
    assert got["a", "figure_coverage"].details == "Coverage 90.0% below 90% threshold"


def test_report_and_measure(spark):
    blocks = spark.createDataFrame([("a", "1", "x"), ("a", "2", "ﬁ"), ("b", None, "x")], "document_id string, source_id string, content string")
    figures = spark.createDataFrame([("a", "mapped")], "document_id string, status string")
    measured = V.measure(blocks, figures)
    assert sorted(map(tuple, measured.collect())) == [("a", 100.0, 1, 100.0), ("b", 0.0, 0, 0.0)]
    got = {r.document_id: r for r in V.report(V.evaluate(measured)).collect()}
    assert [f.gate for f in got["a"].failures] == ["ligature_count"] and got["b"].overall_status == "fail"
    assert V.report(V.evaluate(measured.filter("false"))).count() == 0


def test_attach(spark):
    figures = spark.createDataFrame([("d", "Fig. 4.1", "c1", "one", "1.png"), ("d", "Fig. 4.2", "c2", "two", None)], "document_id string, figure_id string, caption_block_id string, caption string, image_file string")
    texts = ["see FIG. 4.2, Fig. 4.1 and fig. 4.2; Fig. 9.9", "Figure 4.1 and Figs. 4.1", None, "Fig. 4.1"]
    chunks = spark.createDataFrame([("d", 0, i, 0, "c2" if i == 3 else f"t{i}", t, i == 3) for i, t in enumerate(texts)], "document_id string, page int, block int, part int, id string, content string, is_figure_caption boolean")
    got = [[tuple(x) for x in r.figure_references] for r in G.attach(chunks, figures).orderBy("block").collect()]
    assert got == [[("Fig. 4.2", "", "two"), ("Fig. 4.1", "1.png", "one")], [], [], [("Fig. 4.2", "", "two")]]


def test_figure_map_in_both_forms(spark, tmp_path):
    entry = '{"figure_id":"Fig. %s","page_number":1,"caption":"c","caption_block_id":"%s","abbreviations":{"A.":"artery"},"status":"mapped"}'
    flat = '{"x":%s,"y":%s,"z":%s}' % (entry % ("1.1", "b1"), entry % ("1.2", "b2"), entry % ("1.3", "b1"))
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat/a.json").write_text(flat)
    (tmp_path / "nested").mkdir()
    (tmp_path / "nested/a.json").write_text('{"document_id":"d","figures":%s,"summary":{"total_figures":3}}' % flat)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/a.json").write_text('{"x":{"figure_id":"Fig. 1.1"}}')
    for form, doc in (("flat", None), ("nested", "d")):
        got = readers.figure_map(spark, str(tmp_path / form)).orderBy("caption_block_id").collect()
        assert [(r.document_id, r.figure_id, r.abbreviations) for r in got] == [(doc, "Fig. 1.3", {"A.": "artery"}), (doc, "Fig. 1.2", {"A.": "artery"})]
    with pytest.raises(PySparkException):
        readers.figure_map(spark, str(tmp_path / "bad")).collect()


def test_card_reports(spark):
    rows = [(1, "CASO: x verdadeiro", "vascular,clinico", "D", "h"), (2, "q" * 70 + "caso:", "geral", "D", "h"), (3, "caso:", "geral", "M", "")]
    cards = spark.createDataFrame(rows, "card int, question string, tags string, difficulty string, hint string")
    assert {r.category: r.n for r in C.hint_categories(cards).collect()} == {"Casos clinicos": 1, "Abordagens": 0, "V/F": 1, "Vascular clinico": 1, "Outros": 1}
    assert [r.question for r in C.first_hints(cards, "card").collect()] == ["CASO: x verdadeiro...", "q" * 60 + "..."]
    names = {name for _, name in C.PRESETS} | {C.DEFAULT_PRESET}
    assert {r.name for r in C.presets(spark).collect()} == names


def test_hint_rules(spark):
    rows = [("Caso: x", "", "", "A-B-C", "Lembre-se: A-B-C"), ("Caso: x", "", "forame-monro", "x=y", "Pense nas estruturas adjacentes ao forame de Monro"), ("q", "3 Hs", "geral", "", "Mnemônico: 3 Hs (Hemi-)"), ("q", "", "clinico,vascular-arterias", None, "Quais territórios esta artéria irriga?"), ("q", "", "atomizado", "a-b-c-d-e-f-g-h-i-j-k", "Sequência: a-b-c-d-e-f-g-h-i-j-k"), ("q", "", "geral", "", C.LAST_HINT)]
    cards = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, question string, answer string, tags string, mnemonic string, want string")
    got = cards.orderBy("i").select(C.hint(cards.question, cards.answer, cards.tags, cards.mnemonic).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
