"""Gates of ingested documents: how much was kept, what ligatures are left, how many figures have images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the reference's for right results.
#: id, name, comparator, threshold, how it is shown, decimals of the actual value.
GATES = (
    ("parse_rate", "Parse Rate", "gte", 100.0, "100%", 2),
    ("ligature_count", "Ligature Count", "eq", 0.0, "0", 0),
    ("figure_coverage", "Figure Coverage", "gt", 90.0, ">90%", 1),
)


def gate(key: str) -> tuple:
    """The gate of that id; ValueError names the ids that there are."""
    for g in GATES:
        if g[0] == key:
            return g
    raise ValueError(f"no gate {key}; there are {', '.join(g[0] for g in GATES)}")


COMPARATORS = {"gte": lambda a, b: a >= b, "gt": lambda a, b: a > b, "lte": lambda a, b: a <= b, "eq": lambda a, b: a == b}


def parse_rate(output_blocks: Column, source_blocks: Column) -> Column:
    """Percent of the source's blocks; 0 without a source."""
    return F.coalesce(F.try_divide(output_blocks * 100.0, F.nullif(source_blocks, F.lit(0))), F.lit(0.0))


def rounded(value: Column, decimals: int) -> Column:
    return F.floor(value * 10**decimals + 0.5) / 10**decimals


def _details(gate: str, value: Column, passed: Column, threshold: float) -> Column:
    share = F.format_string("%.1f", value)
    if gate == "ligature_count":
        return F.when(passed, F.lit("No ligature characters found")).otherwise(F.concat(F.lit("Found "), value.cast("long").cast("string"), F.lit(" ligature characters")))
    label, above = ("Parse rate ", "% meets threshold") if gate == "parse_rate" else ("Coverage ", "% exceeds threshold")
    return F.concat(F.lit(label), share, F.when(passed, F.lit(above)).otherwise(F.lit(f"% below {threshold:g}% threshold")))


def evaluate(measured: DataFrame) -> DataFrame:
    """measured: document_id and a column for each gate's id. One row for each document and gate:
    document_id, gate, name, threshold, actual, status, details. A null measure fails."""

    def one(gate: tuple) -> Column:
        key, name, comparator, threshold, shown, decimals = gate
        value = F.col(key).cast("double")
        passed = F.coalesce(COMPARATORS[comparator](value, F.lit(threshold)), F.lit(False))
        return F.struct(F.lit(key).alias("gate"), F.lit(name).alias("name"), F.lit(shown).alias("threshold"), rounded(value, decimals).alias("actual"), F.when(passed, "pass").otherwise("fail").alias("status"), F.coalesce(_details(key, value, passed, threshold), F.lit("not measured")).alias("details"))

    return measured.select("document_id", F.inline(F.array(*[one(g) for g in GATES])))


def report(results: DataFrame) -> DataFrame:
    """document_id, overall_status and the failures, by gate."""
    failed = F.when(F.col("status") == "fail", F.struct("gate", F.col("details").alias("reason")))
    return results.groupBy("document_id").agg(F.when(F.bool_and(F.col("status") == "pass"), "pass").otherwise("fail").alias("overall_status"), F.sort_array(F.collect_list(failed)).alias("failures"))


def measure(blocks: DataFrame, figures: DataFrame) -> DataFrame:
    """The measures of each document, from blocks (document_id, source_id, content) and figures
    (document_id, status). source_id is null where a block has no source; a document without figures has a coverage of 0."""
    from ..functions import text as T

    of_blocks = blocks.groupBy("document_id").agg(parse_rate(F.count("content"), F.count("source_id")).alias("parse_rate"), F.sum(T.ligature_count(F.col("content"))).alias("ligature_count"))
    share = F.count_if(F.col("status") == "mapped") * 100.0 / F.count(F.lit(1))
    of_figures = figures.groupBy("document_id").agg(share.alias("figure_coverage"))
    return of_blocks.join(of_figures, "document_id", "left").withColumn("figure_coverage", F.coalesce("figure_coverage", F.lit(0.0)))
