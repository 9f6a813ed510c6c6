import duckdb
from pyspark.sql import functions as F

from tests.llm import brute
from twinproof.llm.components import connected_components
from twinproof.llm.urls import judge_urls

PAGES = [
    (1, "http://a.example.com/en/1", None, "example.com/en/", "block"),
    (2, "https://www.example.com/en/1#x", "", "www.example.com/en/", "allow"),
    (3, "http://q.org/p", '<link rel="canonical" href="http://a.example.com/en/1">', None, "block"),
    (4, "http://q.org/other", "<link href=/p rel='canonical'>", None, "block"),
    (5, "http://q.org/free", '<meta http-equiv="refresh" content="0; url=http://ok.com/x?a=1&amp;b=2">', None, "allow"),
    (6, "http://z.org/1", '<link rel=canonical href="http://x.net/es/">', None, "block"),
    (7, "http://ok.com/", '<link rel=canonical href="http://x.net/es/other">', "com/", "allow"),
    (8, "http://z.org/2", '<link rel=canonical href="http://x.net/es/other">', None, "allow"),
    (9, "http://z.org/3", '<!-- <link rel=canonical href="http://x.net/es/"> --><script>"<link rel=canonical href=http://x.net/es/>"</script>', None, "allow"),
    (10, None, '<link rel=canonical href="http://x.net/es/">', None, "allow"),
    (11, "no scheme", "x", None, "allow"),
    (12, "http://com", None, None, "allow"),
    (13, "HTTP://EXAMPLE.COM/en/?q", None, "example.com/en/", "block"),
    (14, "http://notexample.com/en/", None, "com/", "allow"),
    (15, "http://q.org/p?page=2", None, None, "allow"),
    (16, "http://É.net/fr/", None, "net/fr/", "block"),
    (None, "http://q.org/p", None, None, "block"),
    (3, "http://q.org/p", None, None, "block"),
]


def test_verdicts(spark):
    table = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h, *_ in PAGES], "page_id long, url string, html string, node int, verdict string")
    got = brute.Counter((r.page_id, r.rule, r.verdict) for r in judge_urls(table).collect())
    assert got == brute.Counter((i, r, v) for i, _, _, r, v in PAGES)
    parts = {(r.host, r.path) for r in judge_urls(table).where("page_id IN (10, 11, 12, 13, 16)").collect()}
    assert parts == {("", ""), ("com", ""), ("example.com", "/en/"), ("É.net", "/fr/")}
    assert judge_urls(table.limit(0)).count() == 0


def test_known_redirects(spark):
    table = spark.createDataFrame([(1, "http://s.org/a", None)], "page_id long, url string, html string")
    hops = [("http://s.org/a", "http://s.org/b"), ("http://s.org/b", "http://x.net/fr/"), (None, "http://s.org/a"), ("http://s.org/a", "http://s.org/a")]
    assert judge_urls(table, redirects=spark.createDataFrame(hops, "from_url string, to_url string")).first().verdict == "block"


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(300)] + [(500, 501), (501, 502), (502, 500), (7, 7), (None, 3), (40, 39)]
    got = connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    want = {k: v for k, v in brute.components([e for e in edges if None not in e and e[0] != e[1]]).items()}
    assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
    assert got.where(F.col("root").isNull()).count() == 0


def test_sql_agrees_on_odd_pages(spark, tmp_path):
    from tests.oracle import compare
    from twinproof.llm.queries import ORACLE, QUERIES

    spark.createDataFrame([p[:3] for p in PAGES], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert compare(QUERIES["op7_redirect_equivalence"](spark, str(tmp_path)), con, ORACLE["op7_redirect_equivalence"]) is None
