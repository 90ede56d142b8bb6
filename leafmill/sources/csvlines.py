"""Flashcard files by line: comma-separated with quotes that toggle, and the tab-separated import form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: a quoted stretch: doubled quotes inside, closed by a quote or by the end of the line
_QUOTED = r'"((?:[^"]++|"")*+)(?:"|\z)'
_FIELD = r',((?:[^",]++|"(?:[^"]++|"")*+(?:"|\z))*+)'


def fields(line: Column) -> Column:
    """The fields of one line; a comma within quotes is text, a doubled quote within quotes is a quote."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.transform(raw, lambda x: F.replace(F.regexp_replace(x, _QUOTED, "$1"), F.lit('""'), F.lit('"')))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """line (an order within and across files), value."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    return rows.select(F.struct("file", "start", "n").alias("line"), "value")


def cards(spark: SparkSession, path: str, least: int = 4) -> DataFrame:
    """line, question, answer, tags, mnemonic, difficulty, hint (null if the line ends before) of the lines that
    aren't blank, but for the first of a file and those of fewer than `least` fields."""
    rows = lines(spark, path).filter(T.js_trim(F.col("value")) != "")
    heads = rows.groupBy(F.col("line.file").alias("file")).agg(F.min("line").alias("head"))
    # one row a file: whether it is broadcast is Spark's choice, by its size
    body = rows.join(heads, F.col("line.file") == F.col("file")).filter("line > head")
    parsed = body.select("line", fields(F.col("value")).alias("f")).filter(F.size("f") >= least)
    names = ("question", "answer", "tags", "mnemonic", "difficulty", "hint")
    return parsed.select("line", *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def notes(spark: SparkSession, path: str, prefix: str = "3V::") -> DataFrame:
    """line, six fields and tag_list of an import file; # lines, blank lines and short lines go, and the first
    prefix of each tag is removed."""
    rows = lines(spark, path).filter((~F.startswith("value", F.lit("#"))) & (T.js_trim(F.col("value")) != "")).select("line", F.split("value", "\t", -1).alias("f")).filter("size(f) >= 6")
    names = ("question", "answer", "tags", "mnemonic", "difficulty", "hint")
    out = rows.select("line", *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])
    at = lambda t: F.instr(t, prefix)
    first = lambda t: F.when(at(t) > 0, F.concat(F.substr(t, F.lit(1), at(t) - 1), F.substr(t, at(t) + len(prefix)))).otherwise(t)
    tags = F.filter(F.split("tags", " ", -1), lambda t: T.js_trim(t) != "")
    return out.withColumn("tag_list", F.transform(tags, first))
