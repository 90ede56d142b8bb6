"""The card programs: difficulty, hints, export package, push to a flashcard server.

    python -m leafmill.plans.cards classify --in CSV --out DIR
    python -m leafmill.plans.cards hints --in CSV --out DIR
    python -m leafmill.plans.cards export --in CSV [--fallback CSV] --out DIR
    python -m leafmill.plans.cards push --in DIR

classify and hints write cards (CSV text) and report (Markdown); hints takes what classify wrote. export writes
import (tab-separated), templates, deck and presets (JSON) and instructions (Markdown); push sends what it wrote.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cards as C
from ..sources import csvlines, notes, sinks

# They must equal the reference's for right results.
HEADER = ("Pergunta", "Resposta", "Tags", "Mnemonico", "Dificuldade", "Hint")
COLUMNS = ("question", "answer", "tags", "mnemonic", "difficulty", "hint")
IMPORT_HEADER = ("#separator:Tab", "#html:true", "#deck:%s", f"#notetype:{notes.NOTE_TYPE}", "#tags column:3", "")
LEVELS = (("E", "Facil"), ("M", "Medio"), ("D", "Dificil"))
PRESET_KEYS = {"desired_retention": "desiredRetention", "learning_steps": "learningSteps", "graduating_interval": "graduatingInterval", "easy_interval": "easyInterval", "maximum_interval": "maximumInterval", "new_cards_per_day": "newCardsPerDay", "maximum_reviews_per_day": "maximumReviewsPerDay"}


def classified(cards: DataFrame) -> DataFrame:
    return cards.withColumn("difficulty", C.difficulty(F.col("question"), F.col("tags")))


def hinted(cards: DataFrame) -> DataFrame:
    """Hints for hard cards; an empty difficulty is medium."""
    graded = cards.withColumn("difficulty", F.coalesce(F.nullif("difficulty", F.lit("")), F.lit("M")))
    return graded.withColumn("hint", F.when(F.col("difficulty") == "D", C.hint(F.col("question"), F.col("answer"), F.col("tags"), F.col("mnemonic"))).otherwise(""))


def exportable(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cards that meet the contract, and the others."""
    return cards.filter(C.valid()), cards.filter(~F.coalesce(C.valid(), F.lit(False)))


def _headed(rows: DataFrame, head: str, value: Column) -> DataFrame:
    """value: head, then the rows' values by line; writing keeps the order."""
    spark = rows.sparkSession
    first = spark.createDataFrame([(0, head)], "at int, value string").select("at", F.lit(None).cast(rows.schema["line"].dataType).alias("line"), "value")
    return first.unionAll(rows.select(F.lit(1).alias("at"), "line", value.alias("value"))).orderBy("at", "line").select("value")


def csv(cards: DataFrame, n: int) -> DataFrame:
    """value: lines of the first n columns, all fields quoted, under their header."""
    return _headed(cards, ",".join(f'"{h}"' for h in HEADER[:n]), C.csv_quoted(*COLUMNS[:n]))


def import_file(cards: DataFrame, deck_name: str) -> DataFrame:
    return _headed(cards, "\n".join(IMPORT_HEADER) % deck_name, C.import_line())


# The headings and labels of the reports, which must equal the reference's for right results.
def difficulty_report(cards: DataFrame) -> str:
    shares = {r.difficulty: r for r in C.distribution(cards).collect()}  # three rows
    rows = [(name, level, shares[level].n if level in shares else 0, shares[level].percent if level in shares else 0.0) for level, name in LEVELS]
    table = "\n".join(f"| {name} ({level}) | {n} | {percent:.1f}% |" for name, level, n, percent in rows)
    return f"# Distribuicao de Dificuldade\n\n**Total de cards**: {sum(r[2] for r in rows)}\n\n| Dificuldade | Quantidade | Percentual |\n|-|-|-|\n{table}\n"


def hint_report(cards: DataFrame) -> str:
    kinds = C.hint_categories(cards).collect()  # five rows
    table = "\n".join(f"| {r.category} | {r.n} |" for r in kinds)
    shown = C.first_hints(cards, "line").collect()  # 15 rows
    examples = "\n".join(f'### {i}. {r.question}\n- **Tags**: `{r.tags}`\n- **Hint**: "{r.hint}"\n' for i, r in enumerate(shown, 1))
    return f"# Hints para Cards Dificeis\n\n**Cards com hints**: {cards.filter("difficulty = 'D'").count()}\n\n| Categoria | Quantidade |\n|-|-|\n{table}\n\n## Exemplos\n\n{examples}"


def templates() -> dict:
    """The note type with its templates and styling."""
    read = lambda name: resources.files(__package__).joinpath("templates", name).read_text(encoding="utf-8")
    return {"name": notes.NOTE_TYPE, "fields": list(notes.FIELDS), "templates": [{"name": notes.CARD_TEMPLATE, "qfmt": read("front.html"), "afmt": read("back.html")}], "css": read("style.css")}


def presets() -> dict:
    names = ("name", *PRESET_KEYS, "description")
    rows = [dict(zip(names, row)) for row in C.PRESET_ROWS]
    return {r["name"]: {PRESET_KEYS.get(k, k): v for k, v in r.items()} | {"fsrsEnabled": True} for r in rows}


def deck(cards: DataFrame, name: str) -> dict:
    row = C.deck(cards, "line").withColumn("now", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()
    return {"deckName": name, "noteTypeName": notes.NOTE_TYPE, "preset": row.preset, "totalCards": row.total, "byDifficulty": {"E": row.n_e, "M": row.n_m, "D": row.n_d}, "exportDate": row.now}


def instructions(config: dict) -> str:
    rows = "\n".join(f"| {p['name']} | {p['desiredRetention']:.2f} | {p['newCardsPerDay']} |" for p in presets().values())
    counts = ", ".join(f"{name} ({level}): {config['byDifficulty'][level]}" for level, name in LEVELS)
    return (
        f"# Importar o deck {config['deckName']}\n\nTotal: {config['totalCards']} cards ({counts}). Preset recomendado: {config['preset']}.\n\n"
        f"1. Criar o note type {config['noteTypeName']} com os campos {', '.join(notes.FIELDS)} e os templates da pasta `templates`.\n"
        f"2. Ativar FSRS e escolher o preset:\n\n| Preset | Retention | Cards/dia |\n|-|-|-|\n{rows}\n\n3. Importar o texto da pasta `import`.\n"
    )


def _save(spark: SparkSession, text: str, path: str) -> None:
    sinks.write(spark.createDataFrame([(text,)], "value string").coalesce(1), path, True, "text")


def classify(spark: SparkSession, source: str, out: str) -> None:
    cards = classified(csvlines.cards(spark, source, 4))
    sinks.write(csv(cards, 5), f"{out}/cards", True, "text")
    _save(spark, difficulty_report(cards), f"{out}/report")


def hints(spark: SparkSession, source: str, out: str) -> None:
    cards = hinted(csvlines.cards(spark, source, 5))
    sinks.write(csv(cards, 6), f"{out}/cards", True, "text")
    _save(spark, hint_report(cards), f"{out}/report")


def export(spark: SparkSession, source: str, out: str, deck_name: str) -> int:
    """Writes the package; the number of cards left out."""
    good, bad = exportable(csvlines.cards(spark, source, 5))
    sinks.write(import_file(good, deck_name), f"{out}/import", True, "text")
    config = deck(good, deck_name)
    for name, value in (("templates", templates()), ("deck", config), ("presets", presets())):
        _save(spark, json.dumps(value, ensure_ascii=False, indent=2), f"{out}/{name}")
    _save(spark, instructions(config), f"{out}/instructions")
    return bad.count()


def push(spark: SparkSession, folder: str, make: Callable[[], Callable] | None = None) -> tuple[int, int]:
    """Sends an exported package; make gives a client (by default that of the settings). Added, duplicates."""
    url, batch, timeout = notes.settings()
    make = make or (lambda: notes.client(url, timeout))

    def read(part: str) -> dict:
        path = f"{folder}/{part}"
        try:
            return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))  # one small file
        except json.JSONDecodeError as e:
            raise ValueError(f"not JSON: {path}") from e

    package, name = read("templates"), read("deck")["deckName"]
    call = make()
    notes.upsert_note_type(call, package)
    call("createDeck", {"deck": name})
    got = notes.push(csvlines.notes(spark, f"{folder}/import"), make, name, batch).first()
    return got.added, got.duplicates


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="cards")
    parser.add_argument("step", choices=("classify", "hints", "export", "push"))
    parser.add_argument("--in", dest="source", required=True)
    parser.add_argument("--fallback", help="what export reads if --in isn't there")
    parser.add_argument("--out")
    parser.add_argument("--deck", help="the name of the deck that export writes")
    given = parser.parse_args(args)
    if given.step != "push" and not given.out:
        parser.error("--out is needed")
    if given.step == "export" and not given.deck:
        parser.error("--deck is needed")
    spark = SparkSession.builder.appName("leafmill-cards").getOrCreate()
    source = given.source
    if given.fallback:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
        source = source if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path) else given.fallback
    if given.step == "push":
        added, duplicates = push(spark, source)
        print(f"{added} added, {duplicates} duplicates")
    elif given.step == "export":
        print(f"{export(spark, source, given.out, given.deck)} invalid cards left out")
    else:
        {"classify": classify, "hints": hints}[given.step](spark, source, given.out)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
