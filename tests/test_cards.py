"""Card lines, the card programs end to end, and the HTTP sink against a server of our own."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from leafmill.operators import cards as C
from leafmill.plans import cards as P
from leafmill.sources import csvlines, notes


def test_fields(spark):
    wanted = {'a,b': ["a", "b"], 'a,"b,c",d': ["a", "b,c", "d"], '"x ""y"" z",': ['x "y" z', ""], ",": ["", ""], '""': [""], '""""': ['"'], 'a"b,c"d': ["ab,cd"], '"open, to the end': ["open, to the end"], "": [""], ",,x": ["", "", "x"]}
    rows = spark.createDataFrame([(k,) for k in wanted], "line string")
    assert {r.line: r.f for r in rows.select("line", csvlines.fields(F.col("line")).alias("f")).collect()} == wanted


LINES = ['\n"Pergunta","Resposta","Tags","Mnemonico"', '"CASO: um, dois","r","clinico","x=y"', "", "V.C.I. = ___,r,abreviacoes,", "só três,campos,aqui", '"diz ""sim""","r\t1","geral",""']


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    P.classify(spark, str(tmp_path / "a.csv"), str(tmp_path / "c"))
    return tmp_path


def text(spark, path):
    return "\n".join(r.value for r in spark.read.text(str(path), wholetext=True).withColumn("f", F.input_file_name()).orderBy("f").collect()).strip("\n")


def test_programs(spark, folder):
    assert [x for x in text(spark, folder / "c/cards").split("\n") if x] == ['"Pergunta","Resposta","Tags","Mnemonico","Dificuldade"', '"CASO: um, dois","r","clinico","x=y","D"', '"V.C.I. = ___","r","abreviacoes","","E"', '"diz ""sim""","r\t1","geral","","M"']
    assert "| Facil (E) | 1 | 33.3% |" in text(spark, folder / "c/report")
    P.hints(spark, str(folder / "c/cards"), str(folder / "h"))
    rows = [x for x in text(spark, folder / "h/cards").split("\n") if x]
    assert rows[1].endswith('"D","Analise a localização anatômica e estruturas adjacentes"') and rows[2].endswith('"E",""')
    assert "| Casos clinicos | 1 |" in text(spark, folder / "h/report") and "### 1. CASO: um, dois..." in text(spark, folder / "h/report")
    assert P.export(spark, str(folder / "h/cards"), str(folder / "e"), "Some::Deck") == 0
    got = [x for x in text(spark, folder / "e/import").split("\n") if x]
    assert got[:5] == [x.replace("%s", "Some::Deck") for x in P.IMPORT_HEADER[:5]] and got[2] == "#deck:Some::Deck"
    assert got[5:] == ["CASO: um, dois\tr\t3V::clinico\tx=y\tD\tAnalise a localização anatômica e estruturas adjacentes", "V.C.I. = ___\tr\t3V::abreviacoes\t\tE\t", "diz &quot;sim&quot;\tr    1\t3V::geral\t\tM\t"]
    deck = json.loads(text(spark, folder / "e/deck"))
    assert (deck["deckName"], deck["totalCards"], deck["byDifficulty"], deck["preset"]) == ("Some::Deck", 3, {"E": 1, "M": 1, "D": 1}, "3V-Clinical")
    assert json.loads(text(spark, folder / "e/presets"))["3V-Core"]["desiredRetention"] == 0.9
    assert json.loads(text(spark, folder / "e/templates"))["fields"] == list(notes.FIELDS)

    heard, models = [], []

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            heard.append(asked)
            action, params = asked["action"], asked["params"]
            result = list(models) if action == "modelNames" else [None if n["fields"]["Dificuldade"] == "E" else 1 for n in params["notes"]] if action == "addNotes" else None
            if action == "createModel":
                models.append(params["modelName"])
            body = json.dumps({"result": result, "error": "no such action" if action == "odd" else None}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    make = lambda: notes.client(url)
    try:
        assert P.push(spark, str(folder / "e"), make) == (2, 1)
        assert P.push(spark, str(folder / "e"), make) == (2, 1)
        with pytest.raises(RuntimeError, match="no such action"):
            make()("odd")
    finally:
        server.shutdown()
    assert [h["action"] for h in heard if h["action"] != "addNotes"] == ["modelNames", "createModel", "createDeck", "modelNames", "updateModelStyling", "updateModelTemplates", "createDeck", "odd"]
    sent = [n for h in heard if h["action"] == "addNotes" for n in h["params"]["notes"]]
    assert {n["deckName"] for n in sent} == {"Some::Deck"}
    (folder / "e/deck").rename(folder / "e/gone")
    (folder / "e/deck").mkdir()
    (folder / "e/deck/x.txt").write_text("{")
    with pytest.raises(ValueError, match="not JSON"):
        P.push(spark, str(folder / "e"), make)
    assert all(h["version"] == 6 for h in heard) and {t for n in sent for t in n["tags"]} == {"clinico", "abreviacoes", "geral"}


def test_export_leaves_out_invalid(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h,h,h,h,h,h\nq,,t,m,E,\nq,a,t,m,X,\nq,a,t,m,,\nq,a,t,m,M\n")
    assert P.export(spark, str(tmp_path / "a.csv"), str(tmp_path / "e"), "d") == 3
    assert json.loads(text(spark, tmp_path / "e/deck"))["totalCards"] == 1


RULES = [
    ("Caso: x", "", "forame-monro", "", "Pense nas estruturas adjacentes ao forame de Monro"), ("Caso: x", "", "clinico,vascular", "", "Considere as consequências do comprometimento vascular"),
    ("Caso: x", "", "abordagem", "", "Qual estrutura está em risco nesta região?"), ("Caso: x", "", "geral", "", "Analise a localização anatômica e estruturas adjacentes"),
    ("um caso: x", "", "geral", "", C.LAST_HINT), ("Verdadeiro ou falso: x", "", "cirurgico-abordagem", "", "Cuidado com a afirmação - verifique cada termo"),
    ("q", "", "cirurgico-abordagem,transchoroidal", "", "Via transchoroidal = pelo fórnice"), ("q", "", "cirurgico-abordagem,interforniceal", "", "Interforniceal = entre os fórnices, preservando colunas"),
    ("q", "", "translaminar,cirurgico-abordagem", "", "Translaminar = através da lâmina terminal"), ("deve ser preservada", "", "cirurgico-abordagem", "", "Liste mentalmente as estruturas nobres da região"),
    ("a estrutura", "", "cirurgico-abordagem", "", "Pense nos marcos anatômicos desta abordagem"), ("q", "", "cirurgico-abordagem", "", "Qual é o princípio desta abordagem?"),
    ("q", "", "herniacao", "", "Considere a fisiopatologia do processo"), ("a síndrome", "", "geral", "", "Mnemônico: 3 Hs (Hemi-)"), ("q", "os 3 HS", "geral", "", "Mnemônico: 3 Hs (Hemi-)"),
    ("a AChA", "", "vascular-arterias,clinico", "", "Lembre: 3 Hs - cápsula, tálamo, via óptica"), ("q", "", "clinico,vascular-arterias", "", "Quais territórios esta artéria irriga?"),
    ("q", "", "fissura", "", "Fissura = fenda entre fórnice e tálamo"), ("pode sacrificar", "", "veias", "", "Pense no limite seguro de sacrifício venoso"), ("q", "", "caloso", "", "Secção anterior é mais segura"),
    ("em % dos", "", "geral", "", "Lembre-se do valor numérico aproximado"), ("o máximo", "", "geral", "", "Lembre-se do valor numérico aproximado"), ("q", "", "vci,clinico", "", "VCI bilateral = consequência grave"),
    ("q", "a VCI", "clinico", "", "VCI bilateral = consequência grave"), ("Qual a diferença", "", "geral", "", "Compare as características principais"), ("q", "", "atomizado", "um só mnemônico bem longo", "Pense na sequência completa"),
    ("q", "", "atomizado", "um-dois-três-quatro-cinco", "Sequência: um-dois-três-quatro-cinco"), ("q", "", "geral", "ab", C.LAST_HINT), ("q", "", "geral", "a=b", C.LAST_HINT), ("q", "", "geral", "x" * 20, "Lembre-se: " + "x" * 20),
    ("q", "", "geral", "x" * 21, C.LAST_HINT), ("q", None, "geral", None, C.LAST_HINT),
]


def test_every_hint_rule(spark):
    cards = spark.createDataFrame([(i, *r) for i, r in enumerate(RULES)], "i int, question string, answer string, tags string, mnemonic string, want string")
    got = cards.orderBy("i").select(C.hint(cards.question, cards.answer, cards.tags, cards.mnemonic).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert {h for *_, h in C.HINTS} <= {r.want for r in got}
