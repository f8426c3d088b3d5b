from feedloom.llm.registry import URL_RULES, op3_url_filter
from feedloom.llm.url_filter import filter_urls, fit, labelled_urls, score

SCHEMA = "page_id long, url string, host string, rule int"
URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM:80/EN/x?q#f", "http://www.example.com/en/a", "https://example.com/en/", "https://example.com/en", "x://a.net/es/1", "x://anet/es/1", "x://net/fr/?", "x://É.com#/en/", "a://b.com/p://c.net/fr/", "s://com", "http://h.example.net/en/" + "z" * 50_000]


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(URLS)], SCHEMA)
    labelled = spark.createDataFrame([("http://good.org/a", 0), ("http://bad.org/b", 1), (None, 1)], "url string, label int")
    for r in filter_urls(pages, URL_RULES, labelled).collect():
        host, path = plain(URLS[r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))
    assert filter_urls(pages.limit(0), URL_RULES, labelled).count() == 0
    assert {r["score"] for r in filter_urls(pages, URL_RULES, labelled.limit(0)).collect()} == {0.5}


def test_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    rows = op3_url_filter(spark, sf).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_of(host, path)[0])
    table = labelled_urls(spark.read.parquet(f"{sf}/pages.parquet"), URL_RULES, 20).collect()
    assert 0 < len(table) <= 20


def test_learns_from_a_small_table():
    rows = [(f"casino{i}.org", f"/win/{i}", 1) for i in range(20)] + [(f"school{i}.org", f"/class/{i}", 0) for i in range(40)]
    weights = fit(rows)
    assert score("casino99.org", "/win/7", weights) > 0.7 and score("school77.org", "/class/3", weights) < 0.3
