"""Flashcards: difficulty, hints, presets, import rows. Cards have question, answer, tags, mnemonic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# They must equal the reference's for right results.
HARD_PATTERN = "clinico|casos-integrados|patologia|^caso:|^caso integrador:|verdadeiro ou falso|qual a diferença|por que é mais seguro"
EASY_WORDS = "abreviacoes|mnemonicos"
EASY_END = r"= ___\z"
HARD_TAGS = "cirurgico-abordagem|cirurgico-endoscopia|vascular-clinico|herniacao|aneurisma"
PRESETS = (("cirurgico-", "3V-Surgical"), ("clinico|casos-integrados", "3V-Clinical"), ("vascular-", "3V-Vascular"), ("abreviacoes|mnemonicos", "3V-Reference"))
DEFAULT_PRESET = "3V-Core"
#: (question, tags, answer) patterns, all of which must be found, and the hint.
HINTS = (
    ("^caso:", "forame-monro", "", "Pense nas estruturas adjacentes ao forame de Monro"),
    ("^caso:", "(?=.*vascular)(?=.*clinico)", "", "Considere as consequências do comprometimento vascular"),
    ("^caso:", "cirurgico|abordagem", "", "Qual estrutura está em risco nesta região?"),
    ("^caso:", "", "", "Analise a localização anatômica e estruturas adjacentes"),
    ("verdadeiro ou falso", "", "", "Cuidado com a afirmação - verifique cada termo"),
    ("", "(?=.*cirurgico-abordagem)(?=.*transchoroidal)", "", "Via transchoroidal = pelo fórnice"),
    ("", "(?=.*cirurgico-abordagem)(?=.*interforniceal)", "", "Interforniceal = entre os fórnices, preservando colunas"),
    ("", "(?=.*cirurgico-abordagem)(?=.*translaminar)", "", "Translaminar = através da lâmina terminal"),
    ("preservar|preservada", "cirurgico-abordagem", "", "Liste mentalmente as estruturas nobres da região"),
    ("estrutura", "cirurgico-abordagem", "", "Pense nos marcos anatômicos desta abordagem"),
    ("", "cirurgico-abordagem", "", "Qual é o princípio desta abordagem?"),
    ("", "patologia|herniacao", "", "Considere a fisiopatologia do processo"),
    ("tríade|síndrome|3 hs", "", "", "Mnemônico: 3 Hs (Hemi-)"),
    ("", "", "3 hs", "Mnemônico: 3 Hs (Hemi-)"),
    ("acha|coroidal anterior", "(?=.*vascular-arterias)(?=.*clinico)", "", "Lembre: 3 Hs - cápsula, tálamo, via óptica"),
    ("", "(?=.*vascular-arterias)(?=.*clinico)", "", "Quais territórios esta artéria irriga?"),
    ("", "fissura", "", "Fissura = fenda entre fórnice e tálamo"),
    ("sacrific", "veias", "", "Pense no limite seguro de sacrifício venoso"),
    ("", "caloso", "", "Secção anterior é mais segura"),
    ("%|máximo", "", "", "Lembre-se do valor numérico aproximado"),
    ("", "(?=.*vci)(?=.*clinico)", "", "VCI bilateral = consequência grave"),
    ("", "clinico", "vci", "VCI bilateral = consequência grave"),
    ("qual a diferença|por que é mais", "", "", "Compare as características principais"),
)
LAST_HINT = "Revise o conceito central deste tópico"
PRESET_SCHEMA = "name string, desired_retention double, learning_steps array<string>, graduating_interval int, easy_interval int, maximum_interval int, new_cards_per_day int, maximum_reviews_per_day int, description string"
PRESET_ROWS = [
    ("3V-Core", 0.9, ["10m", "30m"], 1, 4, 180, 15, 100, "Anatomia básica do 3V - equilibrado"),
    ("3V-Vascular", 0.92, ["10m", "30m", "1d"], 2, 5, 180, 10, 80, "Vascularização - retenção maior"),
    ("3V-Surgical", 0.93, ["10m", "30m", "1d"], 2, 5, 150, 8, 60, "Abordagens cirúrgicas - alta retenção"),
    ("3V-Clinical", 0.88, ["15m", "1h"], 1, 3, 120, 5, 50, "Casos clínicos - espaçamento maior"),
    ("3V-Reference", 0.85, ["30m"], 3, 7, 365, 20, 150, "Abreviações e referências - manutenção leve"),
]


def difficulty(question: Column, tags: Column) -> Column:
    q, t = F.lower(question), F.lower(tags)
    either = lambda p: q.rlike(p) | t.rlike(p)
    return (
        F.when(either(HARD_PATTERN), "D")
        .when(either(EASY_WORDS) | q.rlike(EASY_END) | t.rlike(EASY_END) | question.rlike(r"^[A-Z.]+\s*=\s*___\z"), "E")
        .when(t.rlike(HARD_TAGS), "D").when(t.contains("revisao-rapida") | q.contains("%"), "M").when(t.contains("atomizado"), "E").otherwise("M")
    )


def hint(question: Column, answer: Column, tags: Column, mnemonic: Column) -> Column:
    q, a, t, m = F.lower(question), F.lower(answer), F.lower(tags), F.coalesce(mnemonic, F.lit(""))
    out = F.when(F.length(m).between(3, 20) & ~m.contains("="), F.concat(F.lit("Lembre-se: "), m))
    for in_question, in_tags, in_answer, text in HINTS:
        parts = [c.rlike(f"(?s){p}") for c, p in ((q, in_question), (t, in_tags), (a, in_answer)) if p]
        both = parts[0]
        for p in parts[1:]:
            both = both & p
        out = out.when(both, text)
    return out.when(t.contains("atomizado") & m.contains("-"), F.concat(F.lit("Sequência: "), m)).when(t.contains("atomizado"), "Pense na sequência completa").otherwise(LAST_HINT)


def preset(tags: Column) -> Column:
    out = F
    for pattern, name in PRESETS:
        out = out.when(F.lower(tags).rlike(pattern), name)
    return out.otherwise(DEFAULT_PRESET)


def valid() -> Column:
    """The card contract; rows that break it are left out by exports."""
    return (F.col("question") != "") & (F.col("answer") != "") & F.coalesce(F.col("difficulty").isin("E", "M", "D"), F.lit(False))


def distribution(cards: DataFrame) -> DataFrame:
    counts = cards.groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"))
    total = cards.agg(F.count(F.lit(1)).alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select("difficulty", "n", (F.floor(F.col("n") * 1000.0 / F.col("total") + 0.5) / 10).alias("percent"))


def shown_question() -> Column:
    """The question as a report shows it."""
    return F.concat(F.substring("question", 1, 60), F.lit("..."))


def hint_categories(cards: DataFrame) -> DataFrame:
    """category, n of the hard cards; a card counts in each category that it meets, or in Outros."""
    asked = F.lower(shown_question())
    kinds = {"Casos clinicos": asked.contains("caso:"), "Abordagens": F.col("tags").contains("cirurgico-abordagem"), "V/F": asked.contains("verdadeiro"), "Vascular clinico": F.col("tags").contains("vascular") & F.col("tags").contains("clinico")}
    kinds = {name: F.coalesce(met, F.lit(False)) for name, met in kinds.items()}
    kinds["Outros"] = ~F.greatest(*kinds.values())
    counts = cards.filter("difficulty = 'D'").agg(*[F.count_if(met).alias(name) for name, met in kinds.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("category"), F.col(f"`{name}`").alias("n")) for name in kinds])))


def first_hints(cards: DataFrame, order: str, n: int = 15) -> DataFrame:
    """The first n hard cards, as a report shows them."""
    return cards.filter("difficulty = 'D'").orderBy(order).limit(n).select(order, shown_question().alias("question"), "tags", "hint")


def presets(spark: SparkSession) -> DataFrame:
    """The scheduling presets."""
    return spark.createDataFrame(PRESET_ROWS, PRESET_SCHEMA)


def deck(cards: DataFrame, order: str) -> DataFrame:
    """total, counts by difficulty, and the most frequent preset (the first met of equals)."""
    by = cards.groupBy(preset(F.col("tags")).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    primary = by.agg(F.coalesce(F.min_by("p", F.struct(-F.col("n"), F.col("first"))), F.lit(DEFAULT_PRESET)).alias("preset"))
    counts = cards.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("difficulty") == d).alias(f"n_{d.lower()}") for d in "EMD"])
    return counts.join(F.broadcast(primary), F.lit(True))


def import_line(prefix: str = "3V::") -> Column:
    """A tab-separated import row: tabs become blanks, line breaks <br>, quotes entities."""
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\t"), F.lit("    ")), F.lit("\n"), F.lit("<br>")), F.lit('"'), F.lit("&quot;"))
    tags = F.array_join(F.transform(F.split("tags", ","), lambda t: F.concat(F.lit(prefix), F.trim(t))), " ")
    return F.concat_ws("\t", safe(F.col("question")), safe(F.col("answer")), tags, safe(F.col("mnemonic")), F.col("difficulty"), safe(F.col("hint")))


def csv_quoted(*fields: str) -> Column:
    """A CSV line whose fields are all quoted; nulls are empty."""
    return F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(f, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for f in fields])


def csv_field(x: Column) -> Column:
    """Quoted only if it holds a comma, a quote or a line break."""
    return F.when(x.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
