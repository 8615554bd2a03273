from fieldstack.llm.queries import URL_RULES
from fieldstack.llm.url_filter import url_filter

CASES = {   # url: (host, path, rule, verdict)
    "http://a.com/x": ("a.com", "/x", "com/", "allow"),
    "http://A.Com": ("a.com", "", None, "allow"),
    "http://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
    "http://m.www.example.com/en/1": ("m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://net/es/": ("net", "/es/", "net/es/", "block"), "http://b.net/es": ("b.net", "/es", None, "allow"),
    "http://www.bad.org/p/?utm_x=1&b=2&a=1#f": ("www.bad.org", "/p/", None, "block"),
    "x://bad.org/p?a=1&b=2": ("bad.org", "/p", None, "block"), "http://bad.org/p": ("bad.org", "/p", None, "allow"),
    "http://u?://v/": ("u", "", None, "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"),
    None: ("", "", None, "allow"), "http://" + "a" * 5000 + ".org/" + "b" * 20000: ("a" * 5000 + ".org", "/" + "b" * 20000, None, "allow"),
    "http://é.org/\n?": ("é.org", "/\n", None, "allow"),
}


def judge(spark, urls, listed, **kw):
    pages = spark.createDataFrame([(i, u, 5) for i, u in enumerate(urls)], "page_id long, url string, uf_rule int")
    entries = spark.createDataFrame([(x,) for x in listed], "url string")
    got = url_filter(pages, entries, URL_RULES, **kw)
    return [tuple(r) for r in got.orderBy("page_id").select("uf_host", "uf_path", "uf_rule", "uf_verdict").collect()]


def test_cases_and_repeated_rows(spark):
    urls = list(CASES) * 2
    assert judge(spark, urls, ["bad.org/p?a=1&b=2", None, "bad.org/p?a=1&b=2", "b.net/e"]) == [CASES[u] for u in urls]


def test_full_filter_is_still_exact(spark):
    """One block for a thousand entries: nearly every look-up is a possible hit."""
    urls = [f"http://h.org/{i}" for i in range(2000)]
    got = judge(spark, urls, [f"h.org/{i}" for i in range(0, 2000, 2)], max_blocks=1)
    assert [r[3] for r in got] == ["block", "allow"] * 1000


def test_empty(spark):
    assert judge(spark, [], ["a"]) == [] and judge(spark, ["http://x.org/"], []) == [("x.org", "/", None, "allow")]
