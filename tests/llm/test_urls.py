from shapelens.llm import urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = min(fits, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1], r[2] != "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_equals_plain_code(spark, sf_dir):
    odd = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://a.org/x?/y#/z", "x://y://example.org/es/", "http://example.org?/es/",
           "http://example.org/en/17", "http://notexample.org/es/", "http://EXAMPLE.org/es/" + "a/" * 50_000, "http://" + "a." * 50_000 + "com/de/", "http://com/fr", "http://.org/",
           "http://ex\nample.org/es/\nx", "http://example.org/es/"] + ["http://hot.com/de/1"] * 50
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id long, url string").unionByName(
        spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id + 1000 page_id", "url"))
    given = {r.page_id: r.url for r in pages.collect()}
    got = urls.url_report(pages).collect()
    assert len(got) == len(given)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(given[r.page_id], RULES), given[r.page_id]


def test_rules_of_any_kind(spark):
    rules = spark.createDataFrame([("a.b", "/x", "allow"), ("a.b", "/x", "block"), (None, "/", "block"), ("a.b", "/x", "block"), ("b", "", "block"), ("a.b", "/xy", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://a.b/x", 1), ("http://a.b/xyz", 1), ("http://c.b", 1), (None, 1)], "url string, rule int")
    got = {r.url: (r.rule, r.verdict) for r in urls.judge_urls(pages.drop("rule"), rules, ["url"]).collect()}
    assert got == {"http://a.b/x": ("a.b/x", "block"), "http://a.b/xyz": ("a.b/xy", "allow"), "http://c.b": ("b", "block"), None: (None, "allow")}
    none = urls.judge_urls(pages.drop("rule"), rules.where("false"), ["url"], otherwise="block").collect()
    assert {r.verdict for r in none} == {"block"} and len(none) == 4
    assert urls.judge_urls(pages.where("false"), rules, ["url"]).count() == 0


def test_a_url_in_the_query_of_a_host_without_path(spark):
    given = ["http://a.com?u=http://b.com/de/1", "http://a.com#http://b.com/de/1", "http://a.com?u=x://y?z=http://c.com/de/", "http://?http://b.com/de/1",
             "http://a.com/?u=http://b.com/de/1", "http://a.com/de/?u=http://b.com/fr/", "://a.com?://b/de/", ":://a.com/de/", "http:" * 100_000 + "//a.com/de/"]
    got = urls.url_report(spark.createDataFrame(list(enumerate(given)), "page_id long, url string")).collect()
    assert len(got) == len(given)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(given[r.page_id], RULES), given[r.page_id][:80]


def test_statement_on_urls_inside_urls(spark):
    """The DuckDB statement and the operator, on URLs that the test tables do not have."""
    import duckdb
    import pandas as pd

    from shapelens.llm.oracle import ORACLE

    given = ["http://a.com?u=http://b.com/de/1", "http://a.com#http://b.com/de/1", "http://?http://b.com/de/1", "http://a.com/?u=http://b.com/de/1", "://a.com?://b/de/",
             ":://a.com/de/", "http://com/de/x?y#z", "none", None, "http://", "http://A.B.ORG/x\ny", "x://y://example.org/es/", "http://example.org/en/17"]
    pages = pd.DataFrame({"page_id": range(len(given)), "url": given})  # noqa: F841  DuckDB reads it by name
    want = {r[0]: r[1:] for r in duckdb.sql(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE['op6_url_rules']})").fetchall()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_report(spark.createDataFrame(list(enumerate(given)), "page_id long, url string")).collect()}
    assert got == want
