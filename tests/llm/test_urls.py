from pyspark.sql import functions as F

from ledgerlens.llm import urls


def link(u):
    return f'<html><LINK href="{u}" rel="canonical"></html>'


PAGES = [
    (1, "http://a.net/es/x", ""),                                      # blocked by rule
    (2, "https://b.org/copy", link("http://a.net/es/x")),              # alias of 1
    (3, "https://b.org/copy?utm_source=q#top", ""),                    # alias of 2
    (4, "http://www.b.org/copy/", None),                               # alias of 2
    (5, "https://c.com/z", link("https://b.org/copy")),                # alias, but allowed by rule
    (6, "https://d.org/r", '<meta http-equiv="refresh" content="0; url=https://c.com/z">'),   # through 5
    (7, "https://d.org/other", '<link rel="stylesheet" href="http://a.net/es/x">'),
    (8, "HTTP://News.Example.COM/en/1", ""),                           # block example.com/en/
    (9, "https://www.example.com/en/1?x=1", ""),                       # explicit allow
    (10, "https://example.com", ""),                                   # com/ needs a path
    (11, None, link("http://a.net/es/x")),
    (12, "no scheme", ""),
    (13, "https://e.org/dir/page", link("/rel")),
    (14, "https://e.org/rel", link("//a.net/fr/deep")),                # 13 -> 14 -> blocked
    (2, "https://b.org/copy", ""),
    (None, "https://f.net/fr", ""),
    (15, "https://x.notnet/es/", ""),
]
WANT = {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "allow", 8: "block", 9: "allow",
        10: "allow", 11: "allow", 12: "allow", 13: "block", 14: "block", None: "allow", 15: "allow"}


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", "x") for r in rows],
                                 "page_id bigint, url string, html string, host string, verdict string")


def test_blocks_follow_redirects_and_allows_hold(spark):
    got = urls.judge(pages(spark)).collect()
    assert len(got) == len(PAGES)
    assert {r.page_id: r.verdict for r in got} == WANT
    by = {r.page_id: r for r in got}
    assert (by[8].host, by[8].path, by[8].rule) == ("news.example.com", "/en/1", "example.com/en/")
    assert by[9].rule == "www.example.com/en/" and by[5].rule == "com/" and by[10].rule is None
    assert (by[11].host, by[11].path, by[12].host) == ("", "", "")
    assert by[10].path == ""


def test_known_redirects_and_hot_target(spark):
    rows = [(i, f"https://site{i}.org/p", "") for i in range(200)] + [(999, "https://bad.net/fr/x", "")]
    moves = spark.createDataFrame([(f"https://site{i}.org/p", "https://hub.org/") for i in range(0, 200, 2)]
                                  + [("https://hub.org/", "https://bad.net/fr/x"), (None, "https://hub.org/")],
                                  "source string, target string")
    got = {r.page_id: r.verdict for r in urls.judge(pages(spark, rows), redirects=moves).collect()}
    assert got == {i: "block" if i % 2 == 0 or i == 999 else "allow" for i in [*range(200), 999]}


def test_empty_table_and_no_python(spark):
    assert urls.judge(pages(spark, [])).count() == 0
    plan = urls.judge(pages(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert urls.judge(pages(spark), rules=()).where(F.col("verdict") == "block").count() == 0


def test_sql_states_the_same(spark, tmp_path):
    import duckdb

    from oracle_harness import canon

    rows = pages(spark).select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"})
    rows.to_parquet(tmp_path / "pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet'")
    rel = con.sql(urls.SQL)
    got = urls.judge(pages(spark))
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(rel.columns, rel.fetchall())
