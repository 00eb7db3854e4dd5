from paperloom.llm.shared import components
from paperloom.llm.url_filter import Rule, filter_urls, page_links

RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]
CASES = {
    "http://a.example.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "HTTP://WWW.Example.NET/EN/1": ("www.example.net", "/EN/1", "net/", "block"),
    "http://example.net": ("example.net", "", None, "allow"),
    "http://x.net/?q=/en/": ("x.net", "/", "net/", "block"),
    "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
    "ftp://example.com/de/x#y": ("example.com", "/de/x", "example.com/de/", "block"),
    "https://org/fr/": ("org", "/fr/", "org/fr/", "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http:///en/": ("", "/en/", None, "allow"),
    "x?y=http://b.net/a\nb": ("b.net", "/a\nb", "net/", "block"),
}


def judged(spark, pages, links=None):
    schema = "page_id int, url string, key string, host string"
    df = spark.createDataFrame([(i, u, "k", "h") for i, u in enumerate(pages)], schema)
    if links is not None:
        links = spark.createDataFrame(links, "src string, dst string")
    return [
        tuple(r)
        for r in filter_urls(df, RULES, links).select("row.page_id", "judged.*").orderBy("page_id").collect()
    ]


def test_rules(spark):
    urls = [*CASES, "http://x.net/?q=/en/"]
    expected = [(i, *CASES[u]) for i, u in enumerate(urls)]
    assert judged(spark, urls) == expected
    assert judged(spark, urls, []) == expected
    assert judged(spark, []) == []


def test_blocks_reach_aliases_and_explicit_allow_stays(spark):
    chain = [f"http://c{i}.info/p" for i in range(40)]
    pages = [*chain, "https://C7.info/p#part", "http://a.example.net/en/1", "http://free.info/", "bad", None]
    links = [*zip(chain, chain[1:]), (chain[39], "http://spam.net/x"), (chain[5], "http://a.example.net/en/1")]
    links += [("http://free.info/", "http://other.info/"), (None, chain[0]), ("bad", chain[0]), (chain[3], chain[3])]
    got = {r[0]: r[4] for r in judged(spark, pages, links)}
    assert [got[i] for i in range(41)] == ["block"] * 41
    assert [got[i] for i in range(41, 45)] == ["allow"] * 4


def test_links_of_pages(spark):
    html = [
        ("http://a.info/1", "<link rel='canonical' href=\"http://b.net/x?a=1&amp;b=2\"><p>"),
        ("https://a.info/2", "<META http-equiv=refresh content='0; URL=/next'>"),
        ("https://a.info/3", '<link href="//c.org/y" rel="canonical"><link rel=stylesheet href=s.css>'),
        ("https://a.info/4", None),
        (None, "<link rel=canonical href=http://d.org/>"),
    ]
    pages = spark.createDataFrame(html, "url string, html string")
    got = {tuple(r) for r in page_links(pages).collect()}
    assert got == {
        ("http://a.info/1", "http://b.net/x?a=1&b=2"),
        ("https://a.info/2", "https://a.info/next"),
        ("https://a.info/3", "https://c.org/y"),
        (None, "http://d.org/"),
    }


def test_relative_links_of_pages(spark):
    cases = [
        ("http://a.info/x/y/1?q=1#f", "page.html", "http://a.info/x/y/page.html"),
        ("http://a.info/x/y/1", "../z?u=http://b.net/..", "http://a.info/x/z?u=http://b.net/.."),
        ("http://a.info/x/y/1", "../../../..", "http://a.info/"),
        ("http://a.info/x/1?q", "?id=3", "http://a.info/x/1?id=3"),
        ("http://a.info", "./p/./q/", "http://a.info/p/q/"),
        ("http://a.info/x", "/p&#47;r&#x3F;a=1&#38;b=2", "http://a.info/p/r?a=1&b=2"),
        ("http://a.info/x", "mailto:me", None),
        ("no host", "page.html", None),
    ]
    html = [(u, f"<link rel=canonical href='{t}'>") for u, t, _ in cases]
    html.append(("http://a.info/b", '<base target=x href="/far/away/"><link rel="canonical" href="p">'))
    expected = {(u, e) for u, _, e in cases if e} | {("http://a.info/b", "http://a.info/far/away/p")}
    assert {tuple(r) for r in page_links(spark.createDataFrame(html, "url string, html string")).collect()} == expected


def test_components_of_stars_chains_and_loops(spark):
    edges = [(0, i) for i in range(1, 300)] + [(1000 - i, 999 - i) for i in range(150)]
    edges += [(5000, 5000), (None, 3), (7000, 6999), (6999, 7000)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    found = {r["node"]: r["component"] for r in got}
    assert len(got) == len(found) == 300 + 151 + 2
    assert found == {i: 0 for i in range(300)} | {i: 850 for i in range(850, 1001)} | {7000: 6999, 6999: 6999}
