"""The queries that have SQL against it, and columns that clash with working names."""

import duckdb
import pytest
from pyspark.sql import functions as F

from leafmill.llm import langid, line_dedup, mixing, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = db.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    plain = lambda v: repr(round(float(v), 6)) if isinstance(v, (int, float)) else str(v)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(plain(r[c]) for c in names) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_clashing_columns(spark):
    """Columns with the names of working columns go along untouched."""
    names = ["__gone", "__of", "__copy", "__twice", "__in", "__starts", "__changed", "__at", "__key", "__positions", "__hash", "id", "body", "a b", "x.y"]
    text = "one two three four\nfive six seven\neight nine ten"
    rows = [(i, t, "en", "s") for i, t in ((1, text), (2, text), (2, "other words here"), (None, text))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    for got in (line_dedup.line_dedup(docs.withColumn("__removed", F.lit("x")), passage_words=5).drop("__removed"), mixing.mixed(docs), langid.reject(docs)):
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r[n] == f"{n}{'-' if r.doc_id is None else r.doc_id}" for r in rows for n in names)
