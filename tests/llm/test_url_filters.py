from itertools import product

from sidelines.llm import url_filters
from sidelines.llm.registry import URL_RULES


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:n], rest[n:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[3:] if fits else (None, default))


URLS = [None, "", "no url", "http://", "http://net", "http://net/", "HTTP://A.B.Example.NET/en/x?y#z", "https://example.net/en",
        "http://notexample.net/en/", "http://x.example.com/de/", "http://example.com./de/", "http://example.com:80/de/1",
        "http://a.org/fr/fr/", "ftp://org/fr/#/de/", "http://x.org?u=http://a.net/", "a://b://c.net/", "http://É.org/fr/é",
        "http://x\ny.net/\n", "http://..net//", "http://" + "a." * 3000 + "net/" + "b/" * 5000, "http://u@net/"]


def test_every_page_equals_the_plain_rules(spark):
    pages = spark.createDataFrame([(i // 2, u) for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES_SCHEMA)
    found = sorted(map(tuple, url_filters.judge(pages, rules).collect()), key=str)
    expected = sorted(((i // 2, u, *plain(u, URL_RULES)) for i, u in enumerate(URLS + URLS[:3])), key=str)
    assert found == expected


def test_many_overlapping_rules(spark):
    hosts, paths = ["net", "a.net", "b.a.net", "c.org"], ["", "/", "/x", "/x/", "/x/y", "/xy/"]
    rules = [(h, p, "block" if (i * 7) % 3 else "allow") for i, (h, p) in enumerate(product(hosts, paths))]
    rules += [("a.net", "/x/", "block"), (None, "/", "block"), ("net", None, "block"), ("net", "/", None)]
    urls = [f"http://{h}{p}" for h, p in product(["net", "z.net", "a.net", "b.a.net", "q.b.a.net", "c.org", "org"],
                                                ["", "/", "/x", "/xy", "/x/", "/x/y/z", "/y/x/"])]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    frame = spark.createDataFrame(rules, url_filters.RULES_SCHEMA)
    found = {r["url"]: (r["rule"], r["verdict"]) for r in url_filters.judge(pages, frame).collect()}
    whole = [r for r in rules if None not in r]
    assert found == {u: plain(u, whole)[2:] for u in urls}


def test_the_shuffled_join_gives_the_same(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES_SCHEMA)
    before = sorted(map(str, url_filters.judge(pages, rules).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, url_filters.judge(pages, rules).collect())) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables_and_defaults(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], url_filters.RULES_SCHEMA)
    assert [r["verdict"] for r in url_filters.judge(pages, none, "block").collect()] == ["block"]
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES_SCHEMA)
    assert url_filters.judge(pages.limit(0), rules).count() == 0


def test_other_columns_stay(spark):
    rows = [("http://a.net/", 1, "v"), ("http://a.net/", 1, "v"), (None, 2, None)]
    pages = spark.createDataFrame(rows, "url string, `e.x` int, verdict string")
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES_SCHEMA)
    found = url_filters.judged_rows(pages, rules)
    assert found.columns == ["url", "e.x", "verdict", "rule"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        ("http://a.net/", 1, "block", "net/")] * 2 + [(None, 2, "allow", None)]))
