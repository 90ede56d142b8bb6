"""Each query against its SQL, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = entry._plans


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return repr(round(float(v), 9)) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(OWN.ORACLE_SQL))
def test_sql(spark, db, name):
    got = OWN.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = db.execute(OWN.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in want.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in got.collect()) == rows


def test_strip_html_with_entities_cut_short(spark, tmp_path):
    """Titles that end inside an entity, as in the larger tables."""
    pages = ["<title>a &amp; b&amp</title><style>p{}</style>", "<title>a&am</title><style>p{}</style>", "<title>a&a</title>mp;", "x &amp", "&ampThe &copy &copy= &quot", "&amp;amp; &amp;copy;", "&amp&amp;&ampp; &bogus;", "&& &;", "<p> </p>", "", None]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = dict(db.execute(OWN.ORACLE_SQL["strip_html"]).fetchall())
    assert len(want) == len(pages)
    assert {r.page_id: r.value for r in OWN.QUERIES["strip_html"](spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize(("html", "closed", "every"), [("&ampp{}", "&ampp{}", "&p{}"), ("&#65; &#x42; &#67 &#x44", "A B &#67 &#x44", "A B C D"), ("<i>&lt;&nbsp;&eacute;&NotEqualTilde;&#39;</i>", "< é≂̸'", "< é≂̸'")])
def test_strip_html_by_semicolon(spark, html, closed, every):
    got = spark.createDataFrame([(html,)], "x string").select(OWN.T.strip_html(OWN.F.col("x"), strict=True), OWN.T.strip_html(OWN.F.col("x"))).first()
    assert tuple(got) == (closed, every)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
