"""URL rules against a plain comparison of every url with every rule."""

import duckdb
import numpy as np
import pyarrow as pa

from pitchside.llm import url_filter as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("Example.ORG", "/fr/x", "block"), ("a.b.example.org", "", "block"),
         ("com", "/d", "allow"), ("example.com", "", "block"), ("", "/", "allow"),
         (None, "/", "block"), ("x.net", None, "block"), ("net", "/", "allow"), ("k.net", "/a/b/c", "allow")]
URLS = ["http://a.example.net/en/1", "https://Example.NET/de/x?q=/en/", "ftp://net", "http://net/",
        "http://example.com/de/", "http://example.com/de", "http://www.example.com/d", "x://org/fr/",
        "http://example.org/fr/xyz#a/b", "http://example.org/fr/y", "http://a.b.example.org",
        "http://z.a.b.example.org/q", "http://notexample.net/en/", "http://xnet/", "mailto:a@b.net",
        "http://k.net/a/b/cd/e", "http://k.net/a/b/", "http://example.net./en/", "://", "http://", None,
        "", "http://u:p@example.net/en/", "http://example.net:80/en/", "http://a..net//x",
        "see http://q.net/ and http://example.net/en/", "http://x.net\n/\nen/", "http://É.net/É",
        "http://" + "a." * 5000 + "net/" + "b/" * 5000, "http://net/" + "x" * 100000]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for h, p, v in rules:
        if h is None or p is None:
            continue
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, v))
    return host, path, best[2] if best else None, best[3] if best else default


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = U.judge_urls(pages, frame, **more)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()), key=lambda r: r[0])


def test_rules_against_plain_comparison(spark):
    want = [(i, *brute(u, RULES)) for i, u in enumerate(URLS)]
    assert judged(spark, URLS, RULES) == want
    assert judged(spark, URLS, RULES, broadcast_rules=0) == want      # the shuffle join


def test_random_urls(spark):
    r = np.random.default_rng(5)
    host = lambda: ".".join(r.choice(["a", "b", "net", "x"], r.integers(1, 5)))
    path = lambda: "".join("/" + s for s in r.choice(["", "p", "pq", "q"], r.integers(0, 4)))
    rules = [(host(), path(), str(r.choice(["allow", "block"]))) for _ in range(60)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://{host()}{path()}{r.choice(['', '?a=/p', '#p/q'])}" for _ in range(400)]
    urls += urls[:50]                                                  # repeated urls
    assert judged(spark, urls, rules) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_default_empty_tables_and_null_ids(spark):
    assert judged(spark, ["http://a.b/c"], [], default="block") == [(0, "a.b", "/c", None, "block")]
    assert judged(spark, [], RULES) == []
    pages = spark.createDataFrame([(None, "http://net/"), (None, "http://net/")],
                                  "page_id long, url string")
    frame = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert [tuple(x) for x in U.judge_urls(pages, frame).collect()] == [
        (None, "net", "/", "net/", "block")] * 2


def test_sql_gives_the_same(spark):
    pages = pa.table({"page_id": list(range(len(URLS))), "url": pa.array(URLS, pa.string())})
    con = duckdb.connect()
    con.register("pages", pages)
    got = sorted(con.sql(U.OP11_SQL).fetchall(), key=lambda r: r[0])
    assert got == judged(spark, URLS, list(U.RULES))


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string").cache()
    rules = spark.createDataFrame(list(U.RULES), "host string, path string, verdict string")
    plan = U.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
